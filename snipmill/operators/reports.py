"""Counts over records, duplicates and selections.

All of them are plain aggregates that combine in the map tasks, so a source or
language with a third of all rows costs no more than a small one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snipmill.functions.hashing import fingerprint


def yield_report(
    rows: DataFrame, kept: Column, source: str = "source_config_id"
) -> DataFrame:
    """Rows processed and written per source, and over all (null source)."""
    return (
        rows.withColumn("_kept", kept)
        .rollup(source)
        .agg(
            F.count("*").alias("processed"),
            F.count_if("_kept").alias("written"),
            F.grouping(source).cast("int").alias("is_total"),
        )
    )


def zero_yield(report: DataFrame) -> DataFrame:
    """Sources of a yield report that were read and gave nothing."""
    return report.where("is_total = 0 AND processed > 0 AND written = 0")


def dedup_report(records: DataFrame, content: str = "raw_content") -> DataFrame:
    """Records loaded, unique and removed; empty ones count as removed."""
    filled = F.coalesce(F.col(content) != "", F.lit(False))
    return (
        records.select(
            filled.alias("filled"),
            # Half as long in binary form, and this is what gets shuffled.
            F.when(filled, F.unhex(fingerprint(F.col(content)))).alias("snippet_id"),
        )
        .agg(
            F.count("*").alias("loaded"),
            F.countDistinct("snippet_id").alias("unique_records"),
            F.count_if(~F.col("filled")).alias("removed_empty"),
        )
        .withColumn("removed", F.col("loaded") - F.col("unique_records"))
        .withColumn("removed_duplicates", F.col("removed") - F.col("removed_empty"))
    )


def counted_report(spark: SparkSession, loaded: int, empty: int, unique: int) -> DataFrame:
    """The same report from numbers that a stage has counted while it wrote its tables."""
    removed = loaded - unique
    return spark.createDataFrame(
        [(loaded, unique, empty, removed, removed - empty)],
        "loaded bigint, unique_records bigint, removed_empty bigint, removed bigint, "
        "removed_duplicates bigint",
    )


def language_distribution(selection: DataFrame, *keys: str) -> DataFrame:
    """Rows per language; a missing language counts as ``unknown``."""
    language = F.coalesce(F.col("language"), F.lit("unknown")).alias("language")
    return selection.groupBy(*keys, language).agg(F.count("*").alias("n"))
