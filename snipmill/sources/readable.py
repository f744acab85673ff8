"""Lines of text files, also of compressed ones that break off.

Compressed files whose format Python knows are decompressed in steps inside the tasks, so
a file that breaks off, or is no such file, gives every whole line before the fault and
then one row that tells what is wrong and how far it was read. That is one read of each
file, in bounded memory. Only faults of the data are caught: a store that fails, fails
the task, which Spark repeats, so no line is lost for a passing reason.

Tasks get files by size, as Spark plans scans of files. They open them with pyarrow's file
systems (local, S3, GCS, HDFS with its native library). Plain files, which have no end
mark that could be missing, and Hadoop's own block formats are read by Spark.
"""

from __future__ import annotations

import bz2
import re
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snipmill.sources.files import opened

STEP = 1 << 18  # compressed bytes that are read at once
BATCH_LINES, BATCH_BYTES = 2_000, 1 << 22
# Hadoop's block formats have an end mark, but only Spark reads them.
BLOCK_FORMATS = ("lz4", "snappy")

PLACE = "struct<file:string,start:bigint,row:bigint>"
FAULT = "struct<reason:string,reached:bigint>"
_SALVAGED = "file string, row bigint, value binary, reason string, reached bigint"


@dataclass(frozen=True)
class UnreadableFile:
    """A file that could not be read to its end, and why. ``reached`` are the compressed
    bytes read before that; ``None`` means that nothing of it was used."""

    path: str
    reason: str
    reached: int | None = None


class Fault(Exception):
    """What is wrong with the data of a file."""


def _zstandard():
    import zstandard

    return zstandard.ZstdDecompressor().decompressobj()


_MACHINES: dict[str, Callable] = {
    "gz": lambda: zlib.decompressobj(31),
    "deflate": zlib.decompressobj,
    "bz2": bz2.BZ2Decompressor,
    "zst": _zstandard,
    "zstd": _zstandard,
}
COMPRESSED = f"*.{{{','.join(_MACHINES)}}}"


def decompressed(read: Callable[[int], bytes], machine: Callable) -> Iterator[tuple[int, bytes]]:
    """Pieces of the text and the compressed bytes read so far, through all members of
    the file. Raises :class:`Fault` where the data go wrong or end too early."""
    own, reached, open_ = machine(), 0, False
    while chunk := read(STEP):
        reached += len(chunk)
        while chunk:
            if own.eof:
                chunk = chunk.lstrip(b"\0")  # padding between members
                if not chunk:
                    break
                own = machine()
            open_ = True
            try:
                piece = own.decompress(chunk)
            except Exception as error:  # noqa: BLE001  each format raises errors of its own
                raise Fault(str(error) or type(error).__name__, reached) from error
            chunk = own.unused_data if own.eof else b""
            yield reached, piece
    if open_ and not own.eof:
        raise Fault("the file ends too early", reached)


def split_lines(pieces: Iterable[tuple[int, bytes]]) -> Iterator[bytes]:
    r"""Lines that end with \n, \r\n, \r or the end; a line cut off by a fault is none."""
    rest: list[bytes] = []
    for _, piece in pieces:
        held = rest[-1:] == [b"\r"]
        if not held and b"\n" not in piece and b"\r" not in piece:
            rest.append(piece)
            continue
        data = b"".join(rest) + piece
        # What follows tells whether this ends a line alone or with the next byte.
        last = data.endswith(b"\r")
        *lines, open_ = re.split(rb"\r\n|\n|\r", data[:-1] if last else data)
        yield from lines
        rest = [open_, b"\r"] if last else [open_]
    data = b"".join(rest)
    if data:
        yield data.removesuffix(b"\r")


def _salvaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("file", "row", "value", "reason", "reached")
    types = (pa.string(), pa.int64(), pa.binary(), pa.string(), pa.int64())

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=list(names)
        )

    for files in batches:
        for file in files["path"].to_pylist():
            machine = _MACHINES[file.rpartition(".")[2]]
            rows, size = [], 0
            with opened(file) as stream:
                try:
                    for i, line in enumerate(split_lines(decompressed(stream.read, machine))):
                        rows.append((file, i, line, None, None))
                        size += len(line)
                        if len(rows) >= BATCH_LINES or size >= BATCH_BYTES:
                            yield batch(rows)
                            rows, size = [], 0
                except Fault as fault:
                    rows.append((file, None, None, *fault.args))
            yield batch(rows)


def salvaged_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the compressed files below ``path``, and a row without a value, but with
    a ``fault``, for each that could not be read to its end."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", COMPRESSED).load(path)
    found = files.select("path").mapInArrow(_salvaged, _SALVAGED)
    fault = F.when(F.col("reason").isNotNull(), F.struct("reason", "reached"))
    return found.select(
        F.col("value").cast("string").alias("value"),
        F.struct("file", F.lit(0).cast("bigint").alias("start"), "row").cast(PLACE).alias("place"),
        fault.cast(FAULT).alias("fault"),
    )


def _names(spark: SparkSession, path: str, names: str = "*") -> list[str]:
    """Files below a path; their names come to the driver, as whenever Spark lists files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).load(path)
    return [r.path for r in files.select("path").collect()]


def read_lines(spark: SparkSession, path: str, place: Column, left_out: Sequence[str] = ()) -> DataFrame:
    """``value``, ``place`` and ``fault`` of all lines below ``path``, without some files."""
    files = _names(spark, path)
    salvage = [f for f in files if f.rpartition(".")[2] in _MACHINES]
    plain = spark.read.text(path)
    if salvage or left_out:
        rest = sorted(set(files) - set(salvage) - set(left_out))
        plain = spark.read.text(rest) if rest else plain.where(F.lit(False))
    lines = plain.select("value", place.cast(PLACE).alias("place"), F.lit(None).cast(FAULT).alias("fault"))
    return lines.unionByName(salvaged_lines(spark, path)) if salvage else lines


_FAILED = re.compile(
    r"\[FAILED_READ_FILE[^\]]*\] Encountered error while reading file (.+?)\.\s+SQLSTATE"
)


def _plain(path: str) -> str:
    """A path as it is written without an empty host."""
    return re.sub("^([a-z][a-z0-9]*):/+", r"\1:/", path)


def unreadable_blocks(spark: SparkSession, path: str) -> list[UnreadableFile]:
    """Files in block formats below ``path`` that Spark cannot read to their end. They are
    read once more, and again for each found; without such files there is no job."""
    names = f"*.{{{','.join(BLOCK_FORMATS)}}}"
    files = {_plain(f): f for f in _names(spark, path, names)}
    found: list[UnreadableFile] = []
    while len(found) < len(files):
        out = {_plain(f.path) for f in found}
        try:
            rest = [f for key, f in files.items() if key not in out]
            spark.read.text(rest).write.format("noop").mode("overwrite").save()
            break
        except (PySparkException, Py4JJavaError) as error:
            failed = _FAILED.search(str(error))
            if failed is None or _plain(failed[1]) in out or _plain(failed[1]) not in files:
                raise
            found.append(UnreadableFile(files[_plain(failed[1])], failed[0]))
    return found
