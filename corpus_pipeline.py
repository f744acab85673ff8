"""Training-data pipeline: stages over the documents, each written and reread.

A stage takes the session, the documents its predecessor kept and the folder of
tables. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snipmill.llm import stages
from snipmill.session import new_path

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("quality", stages.drop_low_quality),
    ("near-duplicates", stages.drop_near_duplicates),
    ("decontamination", stages.drop_contaminated),
    ("bpe", stages.encode),
]

# Models, compression and vocabularies are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
