"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # JSON lists of solutions may hold objects with repeated keys.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Snippets can be long: bound the batches sent to Python by bytes too.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}


def build_session(name: str = "snipmill", **more: str) -> SparkSession:
    """Session with the settings above; the master comes from Spark's configuration."""
    builder = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | more).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors see, named by ``spark.checkpoint.dir``.

    Only a local session, as in tests, may run without that setting.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="snipmill-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_folder(spark: SparkSession) -> str:
    """Folder in the shared folder that holds all intermediate tables of this application."""
    return f"{shared_folder(spark).rstrip('/')}/snipmill/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """Unused path in the folder of this application."""
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove_run_folder(spark: SparkSession) -> None:
    """Remove the intermediate tables, when nothing that was derived from them is
    needed any more. The commands do so at their end; a program that uses the
    library decides itself."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a small intermediate table and read it back.

    Cuts the lineage like a checkpoint, but computes the rows once and leaves
    Spark with true file sizes, by which it decides on its own whether the
    table is small enough to broadcast.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
