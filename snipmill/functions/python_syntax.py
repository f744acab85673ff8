"""Facts that need a Python syntax tree: the one Python UDF of the package."""

from __future__ import annotations

import ast
import sys
import warnings

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from snipmill.schemas import SYNTAX_FACTS

_ARROW_TYPE = to_arrow_type(SYNTAX_FACTS)

# Send the functions below to the workers as code: these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _facts(source: str) -> dict:
    """Counts over one syntax tree, or the reason why there is none."""
    found = {"parsed": False, "error": None, "functions": 0, "classes": 0, "imports": []}
    try:
        tree = ast.parse(source)
    except SyntaxError as problem:
        # Fixed value: the wording of a syntax error.
        found["error"] = f"Line {problem.lineno}, Offset {problem.offset}: {problem.msg}"
        return found
    except Exception as problem:
        found["error"] = str(problem)
        return found
    names = set()
    pending = [tree]
    while pending:
        node = pending.pop()
        match node:
            case ast.FunctionDef() | ast.AsyncFunctionDef():
                found["functions"] += 1
            case ast.ClassDef():
                found["classes"] += 1
            case ast.Import(names=aliases) | ast.ImportFrom(names=aliases):
                names.update(alias.name for alias in aliases)
        pending.extend(ast.iter_child_nodes(node))
    return found | {"parsed": True, "imports": sorted(names)}


@F.arrow_udf(SYNTAX_FACTS)
def python_syntax(sources: pa.Array) -> pa.Array:
    """One struct of facts per source text; null for null."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        facts = [None if s is None else _facts(s) for s in sources.to_pylist()]
    return pa.array(facts, _ARROW_TYPE)
