"""Exact removal of duplicate contents with a fixed survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from snipmill.functions.hashing import fingerprint
from snipmill.session import materialise

# A content is hot from so many copies on that are this part of all rows at least.
HOT_COPIES, HOT_SHARE = 1_000, 1_000_000
SALTS = 256  # groups in which the copies of a hot content meet first

# Order that makes "the first record" the same in every run.
KEEP_ORDER = ("language", "source_config_id", "ord")


def drop_empty(records: DataFrame, content: str = "raw_content") -> DataFrame:
    """Records that have content."""
    return records.where(F.col(content) != "")


def hot_contents(records: DataFrame) -> DataFrame | None:
    """Ids of the contents that have more copies than an average task has rows, or ``None``.

    Ids alone are counted, and combined before they move. At least ``HOT_COPIES`` copies
    and a ``HOT_SHARE``-th of all rows make a content hot, so there are at most that many
    hot ones, whatever the input: few enough to be sent to every task.
    """
    rows = Observation()
    counts = records.groupBy("snippet_id").agg(F.count("*").alias("_copies"))
    counted = counts.observe(rows, F.sum("_copies").alias("rows"))
    many = materialise(counted.where(F.col("_copies") >= HOT_COPIES), "hot-contents")
    least = (rows.get["rows"] or 0) / HOT_SHARE
    hot = many.where(F.col("_copies") >= least).select("snippet_id")
    return None if hot.isEmpty() else hot


def keep_first(
    records: DataFrame,
    order: Sequence[str] = KEEP_ORDER,
    content: str = "raw_content",
) -> DataFrame:
    """One record per distinct content, with its ``snippet_id``.

    The rank limit runs in every map task before the shuffle, so however many
    copies a content has, each task passes on one of them. Contents move once;
    finding survivors on narrow columns and joining back would move all copies.

    Copies of hot contents, found beforehand by counting ids, first meet in ``SALTS``
    groups by the task they come from. Each passes on one copy, so the task that picks
    the survivor gets ``SALTS`` of them, not one per map task.
    """
    named = drop_empty(records, content).withColumn("snippet_id", fingerprint(F.col(content)))
    hot = hot_contents(named)
    if hot is not None:
        salt = F.spark_partition_id() % SALTS
        marked = named.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), "snippet_id", "left")
        # Salted before the branches part, where the task still is that of the scan.
        marked = marked.withColumn("_salt", F.when(F.col("_hot"), salt))
        spread = _first(marked.where("_salt IS NOT NULL"), ["snippet_id", "_salt"], order)
        named = marked.where("_salt IS NULL").unionByName(spread).drop("_hot", "_salt")
    return _first(named, ["snippet_id"], order)


def _first(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_copy", F.row_number().over(window)).where("_copy = 1").drop("_copy")
