"""Stage 2: records to a pool of unique, characterized snippets."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from snipmill.operators.characterize import with_characteristics
from snipmill.operators.dedup import KEEP_ORDER, keep_first
from snipmill.operators.reports import counted_report
from snipmill.schemas import POOL
from snipmill.sources.jsonl import export_pool, stored_records
from snipmill.sources.readable import UnreadableFile


def build_pool(records: DataFrame, order: Sequence[str] = KEEP_ORDER) -> DataFrame:
    """Unique snippets with their metrics. Metrics come after the removal of
    duplicates, so no text is analysed twice."""
    return with_characteristics(keep_first(records, order)).select(*POOL.names)


class Stage2(NamedTuple):
    """What became of the records: the duplicate report, the quarantined lines, and
    the files that could not be read to their end."""

    report: DataFrame
    left_out: DataFrame
    unreadable: list[UnreadableFile]


def pool_from_jsonl(
    spark: SparkSession,
    root: str,
    out: str,
    export: str | None = None,
    fail_on_unreadable: bool = False,
) -> Stage2:
    """Build the pool from the records below ``root`` and write it to ``out``.

    Parquet is the working form, of which later stages read only the columns
    they need; ``export`` names a place for JSON Lines as well. Of files that break off
    the whole lines before are used and the rest is reported, or they fail the stage
    before it writes the pool.
    """
    records, left_out, counts, unreadable = stored_records(spark, root)
    if unreadable and fail_on_unreadable:
        raise ValueError("unreadable: " + ", ".join(f.path for f in unreadable))
    build_pool(records, (*KEEP_ORDER, "place")).write.mode("overwrite").parquet(out)
    unique = spark.read.schema(POOL).parquet(out).count()
    if export:
        export_pool(spark.read.schema(POOL).parquet(out), export)
    report = counted_report(spark, counts["loaded"], counts["empty"], unique)
    return Stage2(report, left_out, unreadable)
