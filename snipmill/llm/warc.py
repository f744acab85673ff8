"""WARC records in seekable Zstandard bundles.

A bundle is a file of Zstandard frames that any reader can decompress as a whole.
Each frame holds some whole records and is compressed on its own; a skippable frame
at the end lists the sizes of all frames (the public seekable format of the
Zstandard project). A record is found by its bundle, the number of its frame and its
offset in the decompressed frame, which is what the index table holds; reading it
takes the footer and one frame.

Bundles are written by the tasks of a Spark job, under names that no other attempt
uses, and are closed before their index rows are handed on. The index is a written
table, and only what it names counts: bundles of lost or repeated attempts are
never read. All bundles lie in the shared folder.

Of rows with equal payloads, the one with the smallest id becomes a response record
and the others revisit it. Results, defined for every input: a null payload is an
empty payload, which is a payload like others. Rows without an id come after all
ids; they are kept, and as they have nothing to be referred to by, their response
is never revisited. Of rows with equal ids and payloads one is the response and the
others revisit it. Further columns are ignored. Payloads of fewer bytes than
``least_bytes`` are always responses.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snipmill.session import materialise, new_path

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES = 1 << 18  # records are gathered up to this size, then the frame ends
BUNDLE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"

WRITTEN = (
    "record_id string, page_id bigint, bundle string, frame bigint, offset bigint, bytes bigint"
)
READ = (
    "record_id string, page_id bigint, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to bigint, url string, payload binary"
)


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page_id: int, payload_digest: str) -> str:
    return f"urn:page:{page_id}:{payload_digest}"


def record(row: dict, record_id: str) -> bytes:
    """One WARC/1.1 record; a revisit has the headers of its payload, not the payload."""
    payload = row["payload"]
    revisit = row["refers_to"] is not None
    url = re.sub(r"[\x00-\x20\x7f]+", " ", row["url"] or "").strip()
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Payload-Length: {len(payload)}",
    ]
    if row["page_id"] is not None:
        headers.append(f"WARC-Page-ID: {row['page_id']}")
    if revisit:
        headers += [
            f"WARC-Refers-To: <{_uri(row['refers_to'], digest(row['payload']))}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
        payload = b""
    headers += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parsed(data: bytes, offset: int) -> dict:
    """The record at an offset of a decompressed frame."""
    end = data.index(b"\r\n\r\n", offset)
    version, *lines = data[offset:end].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no record at offset {offset}")
    headers = dict(line.split(": ", 1) for line in lines)
    n = int(headers["Content-Length"])
    payload = data[end + 4 : end + 4 + n]
    if data[end + 4 + n : end + 8 + n] != b"\r\n\r\n":
        raise ValueError(f"the record at offset {offset} has a wrong length")
    number = lambda x: None if x is None else int(x.strip("<>").split(":")[2])
    own, kind = headers.get("WARC-Page-ID"), headers["WARC-Type"]
    named = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and digest(payload) != named:
        raise ValueError(f"the record at offset {offset} is damaged")
    return {
        "record_id": headers["WARC-Record-ID"].strip("<>"),
        "page_id": None if own is None else int(own),
        "payload_bytes": int(headers["WARC-Payload-Length"]),
        "payload_digest": named,
        "record_type": kind,
        "refers_to": number(headers.get("WARC-Refers-To")),
        "url": headers["WARC-Target-URI"],
        "payload": payload if kind == "response" else None,
    }


def _file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system of a shared folder, of any kind that pyarrow knows."""
    return pyarrow.fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")


class BundleWriter:
    """Writes one bundle, frame by frame."""

    def __init__(self, folder: str):
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.files, base = _file_system(folder)
        self.files.create_dir(base, recursive=True)
        path = posixpath.join(base, self.name)
        self.out = self.files.open_output_stream(path, compression=None)
        self.frames, self.open_frame, self.size = [], bytearray(), 0
        self.compressor = zstandard.ZstdCompressor(level=3)

    def add(self, data: bytes) -> tuple[int, int]:
        """Number of the record's frame and its offset there."""
        if self.open_frame and len(self.open_frame) + len(data) > FRAME_BYTES:
            self.end_frame()
        at = len(self.frames), len(self.open_frame)
        self.open_frame += data
        return at

    def end_frame(self) -> None:
        if self.open_frame:
            frame = self.compressor.compress(bytes(self.open_frame))
            self.out.write(frame)
            self.frames.append((len(frame), len(self.open_frame)))
            self.size += len(frame)
            self.open_frame = bytearray()

    def close(self) -> None:
        self.end_frame()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)
        self.out.close()


class BundleReader:
    """Random access to the frames of one bundle."""

    def __init__(self, folder: str, name: str):
        files, base = _file_system(folder)
        self.source = files.open_input_file(posixpath.join(base, name))
        size = self.source.size()
        n, _, mark = struct.unpack("<IBI", self._at(size - 9, 9))
        if mark != SEEKABLE:
            raise ValueError(f"{name} has no seek table")
        table = self._at(size - 9 - 8 * n, 8 * n)
        self.frames, at = [], 0
        for packed, plain in struct.iter_unpack("<II", table):
            self.frames.append((at, packed, plain))
            at += packed

    def _at(self, offset: int, n: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(n)

    def frame(self, number: int) -> bytes:
        at, packed, plain = self.frames[number]
        return zstandard.decompress(self._at(at, packed), max_output_size=plain)

    def close(self) -> None:
        self.source.close()


def _write(folder: str):
    """Bundles of the rows of a task, and one index row per record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, rows, first = None, [], None
        for batch in batches:
            for row in batch.to_pylist():
                row["payload"] = (row["payload"] or b"")
                own = digest(row["payload"])
                key = (row["page_id"], own)
                known = row["page_id"] is not None
                if known and key == first and row["refers_to"] is None and row["can_revisit"]:
                    row["refers_to"] = row["page_id"]  # an equal row was written just before
                repeated = key == first
                first = key
                bundle = bundle or BundleWriter(folder)
                name = _uri(row["page_id"], own) if known and not repeated else uuid.uuid4().urn
                data = record(row, name)
                frame, offset = bundle.add(data)
                rows.append(
                    {"record_id": name, "page_id": row["page_id"], "bundle": bundle.name,
                     "frame": frame, "offset": offset, "bytes": len(data)}
                )
                if bundle.size >= BUNDLE_BYTES:
                    bundle.close()
                    yield pa.RecordBatch.from_pylist(rows, schema=_WRITTEN)
                    bundle, rows = None, []
        if bundle:
            bundle.close()
            yield pa.RecordBatch.from_pylist(rows, schema=_WRITTEN)

    return run


_WRITTEN = pa.schema(
    [("record_id", pa.string()), ("page_id", pa.int64()), ("bundle", pa.string()),
     ("frame", pa.int64()), ("offset", pa.int64()), ("bytes", pa.int64())]
)
_READ = pa.schema(
    [("record_id", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
     ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
     ("url", pa.string()), ("payload", pa.binary())]
)


def write_bundles(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """Write one record per row to bundles in ``folder``; returns the index, a written table.

    Payload digests are compared first, without the payloads. Then rows are dealt
    out by id, so equal payloads need not meet; only repeated rows do, one by one.
    """
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("payload_digest", F.sha1("payload"))
    # The smallest id of each payload that several ids have.
    firsts = (
        rows.where(F.col("page_id").isNotNull() & (F.octet_length("payload") >= least_bytes))
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
    )
    shared = materialise(firsts.where("first <> last").drop("last"), "shared-payloads")
    ids = rows.select("page_id", "payload_digest").join(shared, "payload_digest")
    revisits = ids.where("page_id <> first").select(
        "page_id", "payload_digest", F.col("first").alias("refers_to")
    )
    revisits = materialise(revisits.distinct(), "revisits")
    # Rows without id revisit by digest alone, as far as some id has their payload.
    with_id = rows.where("page_id IS NOT NULL")
    with_id = with_id.repartition("page_id", "payload_digest").join(
        revisits, ["page_id", "payload_digest"], "left"
    )
    without = rows.where("page_id IS NULL").join(
        firsts.select("payload_digest", F.col("first").alias("refers_to")), "payload_digest", "left"
    )
    columns = ["page_id", "url", "payload", "payload_digest", "refers_to"]
    dealt = (
        with_id.select(*columns)
        .sortWithinPartitions("page_id", "payload_digest")
        .unionByName(without.select(*columns))
        .withColumn("can_revisit", F.octet_length("payload") >= least_bytes)
    )
    return materialise(dealt.mapInArrow(_write(folder), WRITTEN), "warc-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that an index names, read frame by frame by their offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, name, number, data = None, None, None, b""
        for batch in batches:
            rows, size = [], 0
            for row in batch.to_pylist():
                if row["bundle"] != name:
                    if reader:
                        reader.close()
                    name, number = row["bundle"], None
                    reader = BundleReader(folder, name)
                if row["frame"] != number:
                    number, data = row["frame"], reader.frame(row["frame"])
                found = parsed(data, row["offset"])
                if found["record_id"] != row["record_id"]:
                    raise ValueError(f"the index is wrong about {row['record_id']}")
                rows.append(found)
                size += found["payload_bytes"]
                if size >= 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=_READ)
        if reader:
            reader.close()

    return index.sortWithinPartitions("bundle", "frame", "offset").mapInArrow(run, READ)


def archive_folder(pages: DataFrame) -> str:
    """New folder for bundles in the shared folder."""
    return new_path(pages.sparkSession, "bundles")
