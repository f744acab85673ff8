"""Source-code texts derived from the ``part`` table.

The given tables hold prose only. These SQL expressions, valid in Spark and in
DuckDB alike, turn each part into a snippet of one of six languages. Texts
repeat with the name and size of the part, and C and C++ share one text, so
equal contents occur within and across languages.
"""

from __future__ import annotations

_VT, _FF, _FS, _NEL, _LS, _NBSP = map(chr, (0x0B, 0x0C, 0x1C, 0x85, 0x2028, 0xA0))

LANGUAGE = (
    "CASE p_partkey % 6 WHEN 0 THEN 'python' WHEN 1 THEN 'cpp' WHEN 2 THEN 'java' "
    "WHEN 3 THEN 'rust' WHEN 4 THEN 'c' ELSE 'Go' END"
)

# <n>: the name of the part as an identifier, <s>: its size.
_PYTHON = """# box <s>
import a.b
import <n>
from os import path
from <n> import path, walk
class Box_<n>:
    # held values
    def put(self, x):  # inline
        def inner(y):
            return y
        return inner(x)
    async def get(self):
        return <s>
"""
_PYTHON_STEP = "def step(v):\n    # one step\n    return v\n"
_PYTHON_BROKEN = "def f(:\n"

_C = f"""#include <stdio.h>\r
# include <spaced.h>\r
  #include "<n>.h"{_LS}{_NBSP}#include "wide.h"
/* size
   <s> */
static struct <n> make(void) {{ return one; }}
 class Box_<n> {{ Box_<n>() {{}} }};
class Other {{ Other() {{}} }};{_VT}int domain(int v) {{
  if (v) {{ // inline
  }}
}}
#define F(x) {{ x }}
// tail <n>{_FS}\t//{_NEL}
"""
_C_STEP = "\tint helper(int v) { return v; }\r\n"

_JAVA = f"""import java.util.List;
  import java.<n>;
import\x20
import{_NBSP}java.io.File;
public class <n> {{
abstract class Open_<n>
{{
// size <s>
  // second{_FF}/* block */ int a;
  int b; */
"""
_JAVA_MAIN = "  public static void main(String[] args) { run(); }\n"
_JAVA_ODD_MAIN = "  public static void main(String [] args) { run(); }\n"
_JAVA_STEP = "  class Inner { } // inner\r"

_RUST = f"""use std::io;
  use crate::<n>;
use\x20
pub fn run_<n>() {{
fn\x20
fn helper() {{}}
struct A_<n>;
pub struct B;
impl A_<n> {{
impl<T> B<T> {{
unsafe impl Send for B {{}}
// size <s>
 // more{_NBSP}
"""
_RUST_MAIN = "fn main() {\n}\n"
_RUST_ODD_MAIN = "fn main(x) {\n}\n"
_RUST_STEP = "    fn extra(&self) {}\n"

_GO = "package <n>\n\nfunc size() int { return <s> }"


def _filled(text: str) -> str:
    assert "'" not in text and "\\" not in text
    return (
        f"replace(replace('{text}', '<n>', replace(p_name, ' ', '_')), "
        "'<s>', CAST(p_size AS STRING))"
    )


# Whether the Python text of a part does not parse, and how often its last
# block is repeated: all that is needed to know its syntax tree.
BROKEN = "p_size % 5 = 0"
STEPS = "p_size % 4"

CONTENT = f"""CASE p_partkey % 6
WHEN 0 THEN concat({_filled(_PYTHON)}, repeat('{_PYTHON_STEP}', {STEPS}),
  CASE WHEN {BROKEN} THEN '{_PYTHON_BROKEN}' ELSE '' END)
WHEN 2 THEN concat({_filled(_JAVA)}, repeat('{_JAVA_STEP}', {STEPS}),
  CASE WHEN p_size % 2 = 0 THEN '{_JAVA_MAIN}' ELSE '{_JAVA_ODD_MAIN}' END)
WHEN 3 THEN concat({_filled(_RUST)}, repeat('{_RUST_STEP}', {STEPS}),
  CASE WHEN p_size % 2 = 0 THEN '{_RUST_MAIN}' ELSE '{_RUST_ODD_MAIN}' END)
WHEN 5 THEN {_filled(_GO)}
ELSE concat({_filled(_C)}, repeat('{_C_STEP}', {STEPS})) END"""

# The record columns of a part.
RECORD_COLUMNS = {
    "original_id": "CAST(p_partkey AS STRING)",
    "source_config_id": "p_brand",
    "source_hf_name": "'parts'",
    "language": LANGUAGE,
    "raw_content": CONTENT,
    "ord": "p_partkey",
}
