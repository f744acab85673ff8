"""Per-language code metrics in one struct."""

from __future__ import annotations

from collections.abc import Callable, Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snipmill.functions.python_syntax import python_syntax
from snipmill.functions.text import is_closed, pieces, strip, unify_line_ends
from snipmill.schemas import CHARACTERISTICS

# The pieces of a text are its lines, and maybe an empty piece that no line test
# passes.
_TEXT, _PIECES, _SYNTAX, _LANGUAGE = "_text", "_pieces", "_syntax", "_language"


def _count(line_test: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(_PIECES, line_test))


def _starting(prefix: str) -> Callable[[Column], Column]:
    """Test of a stripped line. A prefix may end in a space: a line that holds
    nothing after it loses that space and does not pass. Most lines do not hold
    the prefix anywhere, and need not be stripped."""
    return lambda line: line.contains(prefix) & strip(line).startswith(prefix)


def _holding(*needles: str) -> Callable[[Column], Column]:
    return lambda line: reduce(lambda a, b: a & b, (line.contains(n) for n in needles))


def _any_of(*tests: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda line: reduce(lambda a, b: a | b, (t(line) for t in tests))


def _function_like(line: Column) -> Column:
    return (
        _holding("(", ")", "{")(line)
        & ~_holding(" class ")(line)
        & ~_holding(" struct ")(line)
        & ~_starting("#")(line)
    )


def _text_holds(needle: str) -> Column:
    """True when any line holds the needle; needles have no line end in them."""
    return F.col(_TEXT).contains(needle)


def _python() -> dict[str, Column]:
    parsed = F.col(f"{_SYNTAX}.parsed")
    return {
        "num_functions": F.col(f"{_SYNTAX}.functions"),
        "num_classes": F.col(f"{_SYNTAX}.classes"),
        "imports": F.col(f"{_SYNTAX}.imports"),
        "ast_parse_success": parsed,
        "syntax_error_detail": F.col(f"{_SYNTAX}.error"),
        # Comments are counted only in texts that parse.
        "num_comments": F.when(parsed, _count(_starting("#"))).otherwise(0),
    }


# Metrics that need the syntax tree.
_SYNTAX_METRICS = (
    "num_functions", "num_classes", "imports", "ast_parse_success", "syntax_error_detail",
    "num_comments",
)

# Comment counters that several languages share.
_SLASH_COMMENTS = {"num_comments_sl": lambda: _count(_starting("//"))}
_BLOCK_COMMENTS = {
    "num_comments_ml_lines": lambda: _count(_any_of(_holding("/*"), _holding("*/")))
}


def _c_family() -> dict[str, Column]:
    return {
        "includes": _count(_starting("#include")),
        "main_function": _text_holds("main("),
        "function_defs": _count(_function_like),
        **{k: v() for k, v in (_SLASH_COMMENTS | _BLOCK_COMMENTS).items()},
    }


def _java() -> dict[str, Column]:
    return {
        "num_imports": _count(_starting("import ")),
        "class_defs": _count(_holding("class ", "{")),
        "main_method": _text_holds("public static void main(String[] args)"),
        **{k: v() for k, v in (_SLASH_COMMENTS | _BLOCK_COMMENTS).items()},
    }


def _rust() -> dict[str, Column]:
    return {
        "uses": _count(_starting("use ")),
        "fn_defs": _count(_any_of(_starting("fn "), _holding(" fn "))),
        "struct_defs": _count(_starting("struct ")),
        "impl_blocks": _count(_any_of(_starting("impl "), _holding(" impl "))),
        "main_function": _text_holds("fn main()"),
        **{k: v() for k, v in _SLASH_COMMENTS.items()},
    }


# Which languages get which metrics; any other language gets only the two
# metrics that all have.
METRICS: dict[str, Callable[[], dict[str, Column]]] = {
    "python": _python,
    "c": _c_family,
    "cpp": _c_family,
    "java": _java,
    "rust": _rust,
}


def _characteristics(content: Column, metrics: dict, wanted: Collection[str] | None) -> Column:
    # The average takes line ends into account as they were written.
    loc = F.size(_PIECES) - is_closed(F.col(_TEXT)).cast("int")
    per_field: dict[str, Column] = {
        "loc": loc,
        "avg_line_length": F.when(loc > 0, F.length(content) / loc).otherwise(0.0),
    }
    for metric_set in dict.fromkeys(metrics.values()):
        languages = [name for name, its in metrics.items() if its is metric_set]
        applies = F.col(_LANGUAGE).isin(languages)
        for field, value in metric_set().items():
            if wanted is not None and field not in wanted:
                continue
            others = per_field.get(field, F.lit(None))
            per_field[field] = F.when(applies, value).otherwise(others)
    absent = F.lit(None)
    return F.struct(
        *(
            per_field.get(f.name, absent).cast(f.dataType).alias(f.name)
            for f in CHARACTERISTICS
            if wanted is None or f.name in wanted
        )
    )


def with_characteristics(
    records: DataFrame,
    content: str = "raw_content",
    language: str = "language",
    languages: Collection[str] | None = None,
    wanted: Collection[str] | None = None,
) -> DataFrame:
    """Add ``characteristics``. The stored language keeps its spelling.

    With ``wanted``, the struct has only these metrics, and nothing is planned for
    the others.

    The text is split once, in a projection of its own. The Python UDF gets
    null for all rows of other languages, so their texts never leave the JVM;
    that keeps one scan where a union of languages would need two. Where the
    ``languages`` of the records are known and Python is not among them, no
    UDF is planned at all.
    """
    metrics = {k: v for k, v in METRICS.items() if languages is None or k in languages}
    key = F.lower(F.coalesce(F.col(language), F.lit("unknown")))
    if "python" in metrics and (wanted is None or set(_SYNTAX_METRICS) & set(wanted)):
        sources = F.when(key == "python", F.col(content))
        records = records.withColumn(_SYNTAX, python_syntax(sources))
    return (
        records.withColumns({_LANGUAGE: key, _TEXT: unify_line_ends(F.col(content))})
        .withColumn(_PIECES, pieces(F.col(_TEXT)))
        .withColumn("characteristics", _characteristics(F.col(content), metrics, wanted))
        .drop(_SYNTAX, _LANGUAGE, _TEXT, _PIECES)
    )


def parses_as_python(content: Column) -> Column:
    """Whether a text is Python: a column for reports or an opt-in filter."""
    return python_syntax(content)["parsed"]
