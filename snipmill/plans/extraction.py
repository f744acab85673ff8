"""Stage 1: sources to records, one Spark write per source, several at once."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snipmill.operators.extract import is_long_enough, long_enough, records_of
from snipmill.session import materialise
from snipmill.sources.jsonl import write_records
from snipmill.sources.registry import SOURCES, Source
from snipmill.sources.scans import (
    files_by_contract,
    missing_paths,
    open_source,
    parquet_positions,
    with_positions,
)
from snipmill.streaming.bounded import take

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class SourceStatus:
    """What became of one source."""

    source: str
    status: str
    processed: int = 0
    written: int = 0
    detail: str | None = None

    @property
    def zero_yield(self) -> bool:
        return self.processed > 0 and self.written == 0


def _stream(spark: SparkSession, source: Source, root: str) -> DataFrame:
    """A source read as a bounded stream, as the table that it leaves."""
    path = source.path(root)
    schema = source.schema or spark.read.format(source.format).load(path).schema
    return take(spark, path, schema, source.max_samples, source.format)


def _extract_one(spark: SparkSession, source: Source, root: str, out: str) -> list[SourceStatus]:
    odd: dict[str, list[str]] = {}
    if source.streamed:
        rows = _stream(spark, source, root)
    else:
        odd, good = files_by_contract(spark, source, root)
        rows = open_source(spark, source, root, good if odd and good else None)
    missing = missing_paths(rows.schema, source)
    if missing:
        return [SourceStatus(source.id, "missing fields", detail=", ".join(missing))]
    faults = [
        SourceStatus(source.id, "missing fields", detail=f"{fields}: {', '.join(files)}")
        for fields, files in odd.items()
    ]
    if rows.isEmpty():
        return [SourceStatus(source.id, "empty"), *faults]
    if source.streamed:
        numbered = parquet_positions(materialise(rows, "streamed-rows"))
    else:
        numbered = with_positions(rows, source)
    counts = Observation()
    records = records_of(numbered, source).observe(
        counts,
        F.count(F.lit(1)).alias("processed"),
        F.count_if(is_long_enough(F.col("raw_content"))).alias("written"),
    )
    write_records(long_enough(records), out, source.language, source.id)
    return [SourceStatus(source.id, "done", **counts.get), *faults]


def job_tag(source: Source) -> str:
    """Tag of all jobs of a source, by which they can be cancelled."""
    return f"snipmill-extract-{source.id}"


def _isolated(spark: SparkSession, source: Source, root: str, out: str) -> list[SourceStatus]:
    """A source whose faults are its own. Its jobs have a tag and a scheduler pool."""
    context = spark.sparkContext
    context.addJobTag(job_tag(source))
    context.setLocalProperty("spark.scheduler.pool", source.id)
    try:
        found = _extract_one(spark, source, root, out)
    except Exception as error:
        log.exception("source %s failed", source.id)
        found = [SourceStatus(source.id, "failed", detail=str(error))]
    finally:
        context.removeJobTag(job_tag(source))
    for status in found:
        if status.zero_yield:
            log.warning("source %s: %d rows, none kept", source.id, status.processed)
        if status.status == "missing fields":
            log.error("source %s: missing fields: %s", source.id, status.detail)
    return found


AT_ONCE = 4  # sources that are extracted side by side


def extract_all(
    spark: SparkSession,
    root: str,
    out: str,
    sources: Iterable[Source] = SOURCES,
    at_once: int = AT_ONCE,
) -> list[SourceStatus]:
    """Extract every source below ``root`` into ``out``.

    Sources run side by side, so that one with few or slow tasks does not hold up the
    others. One that fails, or whose jobs are cancelled by their tag, is reported and
    the others go on. Of a source some of whose files lack a field, the others are
    extracted, and a second status names these files. Statuses come in the order of the
    sources. Yields are observed while the records are written, without a further job.
    """
    with ThreadPoolExecutor(at_once) as threads:
        waiting = [
            threads.submit(inheritable_thread_target(spark)(_isolated), spark, source, root, out)
            for source in sources
        ]
        return [status for one in waiting for status in one.result()]


def yield_totals(report: Iterable[SourceStatus]) -> tuple[int, int]:
    """Rows processed and written over all sources."""
    report = list(report)
    return sum(s.processed for s in report), sum(s.written for s in report)
