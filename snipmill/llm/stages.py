"""The stages of the training-data pipeline.

A stage keeps all columns and all clean rows of what it gets. Rows with null or empty
texts are judged like others. Copies and leaks are told by id and text, so a text without
id, or one that shares its id with others, is judged by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snipmill.llm import bpe, compression, decontaminate, minhash, toxicity
from snipmill.llm.common import fold, table
from snipmill.llm.queries import VOCABULARY


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half by a model of four fifths of the labels."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id")) != 0)
    return docs.where(toxicity.scorer(spark, model)(F.col("text")) < 0.5)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose ratios lie in their bands."""
    return docs.where(compression.quality()(F.col("text"))["kept"])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id, or any if none has an
    id. Of rows that are equal in id and text one stays. Rows are known by a 64-bit hash
    of both."""
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", "text"))
    found = minhash.near_duplicates(keyed, id_col="_key")
    groups = found.select(F.col("doc_id").alias("_key"), "component_id").distinct()
    ids = keyed.select("_key", "doc_id").distinct()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key")).alias("first")
    kept = ids.join(groups, "_key").groupBy("component_id").agg(first).select("first._key")
    chosen = keyed.join(kept.hint("merge"), "_key", "left_semi")
    return chosen.groupBy("_key").agg(F.first(F.struct(*docs.columns)).alias("row")).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and digests of them and of the text they decode to."""
    coded = bpe.round_trip(docs, VOCABULARY)
    return coded.select(
        "doc_id",
        "n_tokens",
        "ids",
        bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
        bpe.text_digest(F.col("decoded")).alias("decoded_sha256"),
    )
