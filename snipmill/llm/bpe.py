"""Byte-level BPE: encoding by a segment tree over adjacent pair ranks, and decoding.

A piece of text is a row of symbols. Each adjacent pair has a rank, the place of
its merge in the vocabulary, or none. A segment tree of minima stands over the
pairs; ties go to the left, so its root is always the leftmost pair of lowest
rank. That pair is merged, three leaves change (the merged pair, its left
neighbour and the pair that vanished), and each change climbs one path of the
tree. A piece of n bytes takes O(n log n), however long it is.

Results, defined for every input: a null text is an empty text; an empty text
has no ids and decodes to an empty text. The strings of special tokens inside a
text become their ids, as the tokenizers library does by default. Unknown ids
decode to nothing, and bytes that are not UTF-8 to U+FFFD. Rows are handled one by one,
so ties, repeated rows and further columns do not matter.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space as the tokenizers library sees it, and how byte-level
# vocabularies split a text.
SPACE = r"\t-\r \x85\xa0  -     　"
PIECE = (
    r"'s|'t|'re|'ve|'m|'ll|'d"
    rf"| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
# Pieces never go on over white space, but for a single blank before a word. So a
# text can be cut there first, and what a cut-out word becomes can be kept.
CHUNK = rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"

KEPT_CHUNKS = 500_000  # per Python worker; twice as many with those of the last round
LONGEST_KEPT = 48  # characters
SMALL_BATCH = 500  # rows

ENCODED = "n_tokens bigint, ids array<int>"


def byte_letters() -> list[str]:
    """The letter by which byte-level vocabularies write each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    odd = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(odd)) for b in range(256)]


NONE = 1 << 62  # above every (rank, position)


class MergeTree:
    """Segment tree of the smallest (rank, position) over adjacent pairs.

    Both are held as one number, rank times the number of pairs plus position.
    """

    def __init__(self, ranks: list[int | None]):
        n = self.n = len(ranks)
        size = self.size = 1 << (n - 1).bit_length()
        nodes = [NONE] * size + [NONE if r is None else r * n + i for i, r in enumerate(ranks)]
        nodes += [NONE] * (size - n)
        for i in range(size - 1, 0, -1):
            a, b = nodes[2 * i], nodes[2 * i + 1]
            nodes[i] = a if a < b else b
        self.nodes = nodes

    def lowest(self) -> int:
        """Position of the leftmost pair of lowest rank; -1 if no pair has a rank."""
        root = self.nodes[1]
        return -1 if root == NONE else root % self.n

    def put(self, position: int, rank: int | None) -> None:
        """Set a rank; its path is climbed until a node stays as it is."""
        nodes, i = self.nodes, self.size + position
        value = nodes[i] = NONE if rank is None else rank * self.n + position
        while i > 1:
            other = nodes[i ^ 1]
            if other < value:
                value = other
            i >>= 1
            if nodes[i] == value:
                return
            nodes[i] = value


class Vocabulary:
    """A byte-level BPE vocabulary read from the JSON of the tokenizers library."""

    def __init__(self, source: str):
        data = json.loads(source)
        model, added = data["model"], data["added_tokens"]
        pre, decoder = data["pre_tokenizer"] or {}, data["decoder"] or {}
        plain = not any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges"))
        level = pre.get("type") == decoder.get("type") == "ByteLevel"
        if not (plain and level and pre["use_regex"] and not pre["add_prefix_space"]):
            raise ValueError("not a plain byte-level BPE vocabulary")
        if data["normalizer"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("normalizers and stripping special tokens are not supported")
        ids = model["vocab"]
        letters = byte_letters()
        self.of_byte = [ids[x] for x in letters]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.pairs.setdefault((ids[left], ids[right]), (rank, ids[left + right]))
        byte_of = {x: b for b, x in enumerate(letters)}
        tokens = ids | {t["content"]: t["id"] for t in added}
        self.bytes_of = [b""] * (max(tokens.values()) + 1)
        for token, i in tokens.items():
            known = all(x in byte_of for x in token)
            self.bytes_of[i] = bytes(map(byte_of.get, token)) if known else token.encode()
        self.special = {t["content"]: array("i", [t["id"]]).tobytes() for t in added}
        self.cut = self.special and re.compile(
            "(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")"
        )
        self.chunks, self.piece = re.compile(CHUNK).findall, regex.compile(PIECE).findall
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        symbols = [self.of_byte[b] for b in piece]
        n, pairs = len(symbols), self.pairs
        if n < 2:
            return symbols
        found = [pairs.get(p) for p in zip(symbols, symbols[1:])]
        tree = MergeTree([f and f[0] for f in found])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        while (i := tree.lowest()) >= 0:
            j = after[i]
            symbols[i] = found[i][1]
            alive[j] = False
            k = after[i] = after[j]
            if j < n - 1:
                tree.put(j, None)
            if k < n:
                before[k] = i
                found[i] = pairs.get((symbols[i], symbols[k]))
                tree.put(i, found[i] and found[i][0])
            else:
                tree.put(i, None)
            if (h := before[i]) >= 0:
                found[h] = pairs.get((symbols[h], symbols[i]))
                tree.put(h, found[h] and found[h][0])
        return [s for s, there in zip(symbols, alive) if there]

    def __call__(self, chunk: str) -> bytes:
        """Ids of a chunk, as the bytes of 32-bit numbers."""
        pieces = self.piece(chunk)
        if len(pieces) == 1:
            return array("i", self.merged(chunk.encode())).tobytes()
        return b"".join(map(self.kept_or_new, pieces))

    def kept_or_new(self, chunk: str) -> bytes:
        """Ids of a chunk, kept for the next time if it is short."""
        ids = self.kept.get(chunk)
        if ids is None:
            ids = self.older.get(chunk)
            if ids is None:
                ids = self(chunk)
            if len(chunk) <= LONGEST_KEPT:
                if len(self.kept) >= KEPT_CHUNKS:
                    self.older, self.kept = self.kept, {}
                self.kept[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        parts, kept, new = [], self.kept.get, self.kept_or_new
        for i, segment in enumerate(self.cut.split(text) if self.cut else (text,)):
            if i % 2:
                parts.append(self.special[segment])
            else:
                parts.extend([kept(c) or new(c) for c in self.chunks(segment)])
        return b"".join(parts)

    def decode(self, ids: list[int]) -> str:
        known = self.bytes_of
        try:
            return b"".join(map(known.__getitem__, ids)).decode("utf-8", "replace")
        except (IndexError, TypeError):
            good = (i for i in ids if i is not None and 0 <= i < len(known))
            return b"".join(map(known.__getitem__, good)).decode("utf-8", "replace")


@lru_cache(4)
def vocabulary(source: str) -> Vocabulary:
    """One vocabulary per Python worker."""
    return Vocabulary(source)


def read_vocabulary(path: str) -> str:
    """Text of a vocabulary file. Its size is that of the file, about 2 MB at 50,000 merges."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _lists(parts: list[bytes]) -> pa.Array:
    values = pa.array(np.frombuffer(b"".join(parts), np.int32))
    ends = np.cumsum([0] + [len(p) // 4 for p in parts])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def encoder(spark: SparkSession, path: str):
    """Function from a text column to its ``n_tokens`` and ``ids``."""
    source = spark.sparkContext.broadcast(read_vocabulary(path))

    @F.arrow_udf(ENCODED)
    def encoded(texts: pa.Array) -> pa.Array:
        encode = vocabulary(source.value).encode
        ids = _lists([encode(t or "") for t in texts.to_pylist()])
        n = ids.value_lengths().cast(pa.int64())
        return pa.StructArray.from_arrays([n, ids], names=["n_tokens", "ids"])

    return lambda text: encoded(text.cast("string"))


def decoder(spark: SparkSession, path: str):
    """Function from a column of ids to its text; null ids give an empty text."""
    source = spark.sparkContext.broadcast(read_vocabulary(path))

    @F.arrow_udf("string")
    def decoded(ids: pa.Array) -> pa.Array:
        decode = vocabulary(source.value).decode
        lists = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
        flat = lists.flatten().to_pylist()
        at, out = 0, []
        for n in lists.value_lengths().to_pylist():
            out.append(decode(flat[at : at + (n or 0)]))
            at += n or 0
        return pa.array(out, pa.string())

    return lambda ids: decoded(ids.cast("array<int>"))


def round_trip(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: ``doc_id``, ``n_tokens``, ``ids`` and the text they decode to, ``decoded``.

    One pass does both; it hands on results in small batches, as ids take more
    room than their texts.
    """
    source = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(source.value)
        for batch in batches:
            for at in range(0, len(batch), SMALL_BATCH):
                part = batch.slice(at, SMALL_BATCH)
                coded = [words.encode(t or "") for t in part.column(1).to_pylist()]
                ids = _lists(coded)
                n = ids.value_lengths().cast(pa.int64())
                texts = [words.decode(np.frombuffer(c, np.int32).tolist()) for c in coded]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), n, ids, pa.array(texts, pa.string())],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    return rows.mapInArrow(both, f"doc_id {kind}, {ENCODED}, decoded string")


def ids_digest(ids: Column) -> Column:
    """Hex SHA-256 of decimal ids joined by commas."""
    return F.sha2(F.concat_ws(",", ids.cast("array<string>")).cast("binary"), 256)


def text_digest(text: Column) -> Column:
    """Hex SHA-256 of a text in UTF-8."""
    return F.sha2(text.cast("binary"), 256)
