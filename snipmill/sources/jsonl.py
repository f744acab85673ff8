"""JSON Lines at the edges: stage-1 records and the exported pool.

Layout: ``<root>/<language>/<source id>.jsonl``, where the last part is a file
or a folder of part files. Both are read the same way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, LongType

from snipmill.functions.text import is_visible
from snipmill.schemas import CHARACTERISTICS, POOL, RECORD, TEXT, TEXTS, struct
from snipmill.session import materialise
from snipmill.sources.readable import UnreadableFile, read_lines, unreadable_blocks
from snipmill.sources.scans import is_missing, line_place

# Follows the object of a line when it is parsed, to show that it was all there.
_END = "_end"


def write_records(records: DataFrame, root: str, language: str, source_id: str) -> str:
    """Write the records of one source, replacing what was there."""
    path = f"{root.rstrip('/')}/{language}/{source_id}.jsonl"
    records.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def _parsed_lines(
    spark: SparkSession,
    path: str,
    fields: Mapping[str, DataType],
    left_out: Sequence[str] = (),
) -> DataFrame:
    """Lines with their place, and the list of objects that they hold. A file that
    breaks off has a row with a ``fault`` and without a line.

    Fields of type text take whatever they hold, so a line is bad only if it is
    not one JSON object; other fields are null where they hold something else. Parsing a list of the line and an end mark finds junk
    behind the object, which the parser would skip.
    """
    entry = struct(**fields, **{_END: TEXT})
    place = F.struct(*(c.alias(n.lstrip("_")) for n, c in line_place().items()))
    lines = read_lines(spark, path, place, left_out)
    framed = F.concat(F.lit("["), F.col("value"), F.lit(f',{{"{_END}":"1"}}]'))
    return lines.select(
        F.col("value").alias("line"),
        "place",
        "fault",
        F.from_json(framed, ArrayType(entry), {"allowSingleQuotes": "false"}).alias("parsed"),
    )


def _is_object() -> Column:
    """Whether a line is one object with nothing behind it; never null."""
    parsed = F.col("parsed")
    whole = (F.size(parsed) == 2) & F.get(parsed, F.lit(0)).isNotNull()
    return F.coalesce(whole & F.get(parsed, F.lit(1))[_END].isNotNull(), F.lit(False))


def _good(lines: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The objects as rows. Exploding keeps the parsed list in one place, where
    a filter on it would be pushed down and parse every line again."""
    found = F.explode(F.when(_is_object(), F.slice("parsed", 1, 1))).alias("entry")
    return lines.select("place", found).select(*(f"entry.{f}" for f in fields), "place")


def _bad(lines: DataFrame) -> DataFrame:
    """Quarantine: lines that are not JSON objects, by place. Blank ones vanish."""
    return lines.where(~_is_object() & is_visible(F.col("line"))).select(
        F.col("place.file").alias("file"), F.col("place.start").alias("slice"), "line"
    )


def records_path(root: str) -> str:
    """Record files lie below exactly one level of folders."""
    return f"{root.rstrip('/')}/*/*.jsonl"


def read_records(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Records below exactly one level of folders, and the lines left out.

    Of a compressed file that breaks off, the whole lines before are read;
    :func:`stored_records` tells which these are.

    Records carry ``place``, which follows file and line. It stands in for
    ``ord`` where files written elsewhere have none. A missing root raises
    ``AnalysisException`` before any job starts.
    """
    lines = _parsed_lines(spark, records_path(root), dict.fromkeys(RECORD.names, TEXT))
    records = _good(lines, RECORD.names)
    return records.withColumn("ord", F.col("ord").try_cast("bigint")), _bad(lines)


class StoredRecords(NamedTuple):
    """Records and quarantined lines from one read of the files, the number of records
    and of those without content, and the files that were not read to their end."""

    records: DataFrame
    left_out: DataFrame
    counts: dict[str, int]
    unreadable: list[UnreadableFile]


def stored_records(spark: SparkSession, root: str) -> StoredRecords:
    """Like :func:`read_records`, but every line is read and parsed once: all results
    come from a written table, and the records and those without content are counted
    while it is written. Only the names of faulty files come to the driver."""
    path = records_path(root)
    blocks = unreadable_blocks(spark, path)
    fields = dict.fromkeys(RECORD.names, TEXT)
    lines = _parsed_lines(spark, path, fields, [f.path for f in blocks])
    rows = lines.where(is_visible(F.col("line")) | F.col("fault").isNotNull()).select(
        F.when(_is_object(), F.get("parsed", F.lit(0))).alias("entry"),
        F.when(~_is_object(), F.col("line")).alias("line"),
        "place",
        "fault",
    )
    counts = Observation()
    content = F.col("entry.raw_content")
    stored = materialise(
        rows.observe(
            counts,
            F.count("entry").alias("loaded"),
            F.count_if(F.col("entry").isNotNull() & (F.coalesce(content, F.lit("")) == "")).alias("empty"),
            F.count("fault").alias("faults"),
        ),
        "parsed-lines",
    )
    records = stored.where("entry IS NOT NULL").select(
        *(f"entry.{f}" for f in RECORD.names), "place"
    )
    records = records.withColumn("ord", F.col("ord").try_cast("bigint"))
    bad = stored.where("entry IS NULL AND fault IS NULL").select(
        F.col("place.file").alias("file"), F.col("place.start").alias("slice"), "line"
    )
    known = counts.get
    broken = []
    if known.pop("faults"):
        faults = stored.where("fault IS NOT NULL").select("place.file", "fault.*")
        broken = [UnreadableFile(*r) for r in faults.orderBy("file").collect()]
    return StoredRecords(records, bad, known, [*blocks, *broken])


# Names in the export, per language. Its "imports" are names for Python and a
# count for Java; the pool keeps the two apart.
_EXPORTED = {
    "python": (
        "loc", "num_functions", "num_classes", "imports", "ast_parse_success",
        "syntax_error_detail", "avg_line_length", "num_comments",
    ),
    "c": (
        "loc", "includes", "main_function", "function_defs", "avg_line_length",
        "num_comments_sl", "num_comments_ml_lines",
    ),
    "java": (
        "loc", "num_imports", "class_defs", "main_method", "avg_line_length",
        "num_comments_sl", "num_comments_ml_lines",
    ),
    "rust": (
        "loc", "uses", "fn_defs", "struct_defs", "impl_blocks", "main_function",
        "avg_line_length", "num_comments_sl",
    ),
    None: ("loc", "avg_line_length"),
}
_EXPORTED["cpp"] = _EXPORTED["c"]
_RENAMED = {"num_imports": "imports"}

_RECORD_KEYS = tuple(f for f in RECORD.fieldNames() if f != "ord")


def pool_json(language: Column) -> Column:
    """One JSON object per pool row, with the metrics of its language only."""

    def whole(metrics: tuple[str, ...]) -> Column:
        own = F.struct(
            *(F.col(f"characteristics.{m}").alias(_RENAMED.get(m, m)) for m in metrics)
        )
        row = F.struct(*_RECORD_KEYS, "snippet_id", own.alias("characteristics"))
        return F.to_json(row, {"ignoreNullFields": "false"})

    key = F.lower(F.coalesce(language, F.lit("unknown")))
    text = whole(_EXPORTED[None])
    for name, metrics in _EXPORTED.items():
        if name is not None:
            text = F.when(key == name, whole(metrics)).otherwise(text)
    return text


def export_pool(pool: DataFrame, path: str) -> None:
    """Write the pool as JSON Lines, replacing what was there."""
    pool.select(pool_json(F.col("language")).alias("value")).write.mode("overwrite").text(path)


# Metrics as they are exported; ``imports`` may be names or a count.
_WRITTEN = struct(**{f.name: f.dataType for f in CHARACTERISTICS} | {"imports": TEXT})


def _metrics_as_in_pool() -> Column:
    """Struct with all metrics, from the exported ones."""
    written = F.col("characteristics")
    raw = written["imports"]
    own = {
        "imports": F.when(raw.startswith("["), F.from_json(raw, TEXTS)),
        "num_imports": F.coalesce(written["num_imports"], raw.try_cast("int")),
    }
    fields = (own.get(name, written[name]).alias(name) for name in CHARACTERISTICS.names)
    return F.when(F.col("characteristics").isNotNull(), F.struct(*fields))


def read_pool(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Pool from JSON Lines, and the lines left out. No file: an empty pool."""
    fields = dict.fromkeys(POOL.names, TEXT) | {"characteristics": _WRITTEN}
    try:
        lines = _parsed_lines(spark, path, fields)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        quarantine = struct(file=TEXT, slice=LongType(), line=TEXT)
        return spark.createDataFrame([], POOL), spark.createDataFrame([], quarantine)
    pool = _good(lines, POOL.names).withColumns(
        {"ord": F.col("ord").try_cast("bigint"), "characteristics": _metrics_as_in_pool()}
    )
    return pool.select(*POOL.names), _bad(lines)
