"""Bounded scan of a source as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from snipmill.session import new_path
from snipmill.sources.scans import parquet_positions

FILES_PER_BATCH = 64
POLL_SECONDS = 1


def _wait_for(query: StreamingQuery, n: int | None) -> None:
    """Let a stream run to its end, or until its finished batches had ``n`` rows."""
    rows: dict[int, int] = {}
    while not query.awaitTermination(POLL_SECONDS):
        rows |= {p["batchId"]: p["numInputRows"] for p in query.recentProgress}
        if n is not None and sum(rows.values()) >= n:
            query.stop()
            return


def take(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    n: int | None,
    format: str = "json",
    **options: str,
) -> DataFrame:
    """``n`` rows of the files below ``path``, read as a stream; all rows for None.

    A batch takes in few files, and the stream stops when its batches had enough
    rows, so little of a large source is read. What is too much is cut off the
    written table by file and row, without a task that sees all rows. Which rows
    remain is not fixed. A restarted driver or a lost executor resumes from the
    recorded progress.
    """
    if n == 0:
        return spark.createDataFrame([], schema)
    target = new_path(spark, "stream")
    rows = (
        spark.readStream.schema(schema)
        .format(format)
        .options(**{"maxFilesPerTrigger": str(FILES_PER_BATCH), **options})
        .load(path)
    )
    query = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", f"{target}-progress")
        .trigger(availableNow=True)
        .start()
    )
    _wait_for(query, n)
    written = spark.read.schema(schema).parquet(target)
    return written if n is None else parquet_positions(written, n).drop("ord")
