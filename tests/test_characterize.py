"""Metrics: hand-written texts, and a line-by-line restatement on random ones."""

import random

import pytest
from pyspark.sql import functions as F

from snipmill.functions.python_syntax import python_syntax
from snipmill.operators.characterize import parses_as_python, with_characteristics
from snipmill.schemas import CHARACTERISTICS


def metrics(spark, rows):
    frame = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "i int, language string, raw_content string"
    )
    found = with_characteristics(frame)
    assert found.schema["characteristics"].dataType == CHARACTERISTICS
    return [r.characteristics.asDict() for r in found.orderBy("i").collect()]


def given(values):
    return {k: v for k, v in values.items() if v is not None}


def test_python(spark):
    text = (
        "import a.b, c\nfrom os import path\nfrom x import c as d\n# one\n"
        "class K:\n  def m(self): # no\n    async def n(): pass\n    # two\n"
    )
    good, bad, other = metrics(
        spark,
        [
            ("Python", text),
            ("python", "# comment\ndef f(:\n"),
            ("python", "x = '\x00'"),
        ],
    )
    assert given(good) == {
        "loc": 8, "avg_line_length": len(text) / 8, "num_functions": 2, "num_classes": 1,
        "imports": ["a.b", "c", "path"], "ast_parse_success": True, "num_comments": 2,
    }
    assert bad["ast_parse_success"] is False
    assert bad["num_comments"] == bad["num_functions"] == 0 and bad["imports"] == []
    assert bad["syntax_error_detail"].startswith("Line 2, Offset 7: ")
    assert other["ast_parse_success"] is False and other["syntax_error_detail"]


def test_errors_other_than_syntax_are_reported(spark, column):
    deep = "-" * 100_000 + "1"
    facts = column([(deep,), (None,)], "t string", python_syntax("t"))
    assert facts[0].parsed is False and facts[0].error
    assert facts[1] is None
    assert column([("x = 1",), ("x =",)], "t string", parses_as_python(F.col("t"))) == [
        True, False,
    ]


def test_c_and_cpp(spark):
    text = (
        "#include <a>\n# include <b>\n  #include <c>\r\nint domain(int v) {\n  if (v) { // in\n"
        " // sl\n/* ml\n ml */ x\n static struct s f(void) {\n class A { A() {} };\n"
        "class B { B() {} };\n#define F(x) { x }\n/* a */ /* b */"
    )
    for language in ("c", "cpp", "C"):
        (found,) = metrics(spark, [(language, text)])
        assert given(found) == {
            "loc": 13, "avg_line_length": len(text) / 13, "includes": 2,
            "main_function": True, "function_defs": 3, "num_comments_sl": 1,
            "num_comments_ml_lines": 3,
        }


def test_java(spark):
    text = (
        "import a;\n  import b;\nimport \nimport\u00a0c;\nclass A {\nclass B\n{\n"
        "public static void main(String[] args) {\n// x\n * /* y"
    )
    exact, altered = metrics(spark, [("java", text), ("java", text.replace("[]", " []"))])
    assert given(exact) == {
        "loc": 10, "avg_line_length": len(text) / 10, "num_imports": 2, "class_defs": 1,
        "main_method": True, "num_comments_sl": 1, "num_comments_ml_lines": 1,
    }
    assert altered["main_method"] is False


def test_rust(spark):
    text = (
        "use a;\nuse \n pub fn b() {\nfn c() {\nfn \n  fn \nstruct A;\npub struct B;\n"
        "impl A {\nimpl<T> B {\nunsafe impl C {\nfn main() {\n// z\n"
    )
    (found,) = metrics(spark, [("rust", text)])
    assert given(found) == {
        "loc": 13, "avg_line_length": len(text) / 13, "uses": 1, "fn_defs": 4,
        "struct_defs": 1, "impl_blocks": 2, "main_function": True, "num_comments_sl": 1,
    }


def test_other_languages_get_two_metrics(spark):
    go, none, empty = metrics(spark, [("Go", "a\n\nb"), (None, "x"), ("go", "")])
    assert given(go) == {"loc": 3, "avg_line_length": 4 / 3}
    assert given(none) == {"loc": 1, "avg_line_length": 1.0}
    assert given(empty) == {"loc": 0, "avg_line_length": 0.0}


# Each counter as a test of one line, stated once more in plain Python.
RULES = {
    "c": {
        "includes": lambda s, r: s.startswith("#include"),
        "function_defs": lambda s, r: {"(", ")", "{"} <= set(r)
        and not s.startswith("#") and " class " not in r and " struct " not in r,
        "num_comments_sl": lambda s, r: s.startswith("//"),
        "num_comments_ml_lines": lambda s, r: "/*" in r or "*/" in r,
    },
    "java": {
        "num_imports": lambda s, r: s.startswith("import "),
        "class_defs": lambda s, r: "class " in r and "{" in r,
    },
    "rust": {
        "uses": lambda s, r: s.startswith("use "),
        "fn_defs": lambda s, r: s.startswith("fn ") or " fn " in r,
        "struct_defs": lambda s, r: s.startswith("struct "),
        "impl_blocks": lambda s, r: s.startswith("impl ") or " impl " in r,
    },
}
PIECES = [
    "#include", "# ", "(", ")", "{", " class ", "class ", " struct ", "struct ", "//", "/*",
    "*/", "import ", "use ", "fn ", " fn ", "impl ", " impl ", "fn main()", "main(", "x",
    " ", "\t", "\n", "\n", "\r\n", "\x0b", "\u2028", "\xa0", "\x1f", "\x85",
]


@pytest.mark.parametrize("language", list(RULES))
def test_random_texts_against_the_rules(spark, language):
    dice = random.Random(language)
    texts = [
        "".join(dice.choice(PIECES) for _ in range(dice.randrange(1, 40))) for _ in range(400)
    ]
    for text, found in zip(texts, metrics(spark, [(language, t) for t in texts])):
        split = text.splitlines()
        assert found["loc"] == len(split)
        assert found["avg_line_length"] == len(text) / len(split)
        for name, rule in RULES[language].items():
            assert found[name] == sum(rule(line.strip(), line) for line in split), repr(text)


def test_known_languages_need_no_udf(spark):
    frame = spark.createDataFrame([("rust", "fn a() {")], "language string, raw_content string")
    known = with_characteristics(frame, languages=["rust"])
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan
    assert known.head().characteristics.fn_defs == 1
