"""Token counts per section by offset mapping.

Each whole text is encoded once. Its tokens are intervals of characters that follow
each other, and so are its sections; both are joined by their positions in one pass.
A token inside a section counts there. A token that crosses a boundary counts, as
one, for the section that has most of its characters, and for the first of them
where two have equally many. So the counts of a text's sections add up to its tokens.
A letter that is split over several tokens lies where its last byte is.

Results, defined for every input: a null text is an empty text; an empty text has
one empty section without tokens. An empty section gets a row with no tokens. Strings of
special tokens count as ordinary text. Rows are handled one by one, so ties, repeated
rows and further columns do not matter.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_BATCH = 500  # rows

ATTRIBUTED = (
    "section int, char_start bigint, char_end bigint, n_tokens bigint, crossing_tokens bigint"
)


@lru_cache(2)
def encoding(ranks: str, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """Encoder of a rank file, and the length of each token in bytes."""
    merges = {base64.b64decode(a): int(b) for a, b in map(str.split, ranks.splitlines())}
    sizes = np.zeros(max(merges.values()) + 1, np.int64)
    for token, rank in merges.items():
        sizes[rank] = len(token)
    encoder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
    return encoder, sizes


def token_ends(text: str, encoder: tiktoken.Encoding, sizes: np.ndarray) -> np.ndarray:
    """Characters of the text up to the end of each token."""
    ids = np.array(encoder.encode_ordinary(text), np.int64)
    ends = np.cumsum(sizes[ids])
    data = np.frombuffer(text.encode(), np.uint8)
    if len(data) == len(text):
        return ends
    # A letter is complete with its last byte, which the first byte of the next one follows.
    first = (data & 0xC0) != 0x80
    begun = np.cumsum(first)
    complete = np.append(first[1:], True)
    return begun[ends - 1] - ~complete[ends - 1]


def sections_of(text: str) -> np.ndarray:
    """Ends of the sections of a text: its lines, with their line feed."""
    ends = [i + 1 for i, c in enumerate(text) if c == "\n"] if "\n" in text else []
    if not ends or ends[-1] != len(text):
        ends.append(len(text))
    return np.array(ends, np.int64)


def attributed(token_end: np.ndarray, section_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and how many of them cross a boundary."""
    n = len(section_end)
    counts, crossing = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not len(token_end):
        return counts, crossing
    start = np.concatenate([[0], token_end[:-1]])
    # First section that ends behind the start; last one that begins before the end.
    first = np.minimum(np.searchsorted(section_end, start, "right"), n - 1)
    last = np.maximum(np.searchsorted(section_end, token_end, "left"), first)
    last = np.minimum(last, n - 1)
    inside = first == last
    counts += np.bincount(first[inside], minlength=n)
    for a, b, f, k in zip(start[~inside], token_end[~inside], first[~inside], last[~inside]):
        edges = np.clip(np.concatenate([[a], section_end[f : k + 1]]), a, b)
        best = f + int(np.argmax(np.diff(edges)))
        counts[best] += 1
        crossing[best] += 1
    return counts, crossing


def section_tokens(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per section: ``doc_id``, its number and characters, its tokens, and
    those among them that cross a boundary. ``path`` names a rank file."""
    with open(path, encoding="ascii") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())  # as large as the file
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sizes = encoding(ranks.value, pattern)
        for batch in batches:
            for at in range(0, len(batch), SMALL_BATCH):
                part = batch.slice(at, SMALL_BATCH)
                found = []
                for text in part.column(1).to_pylist():
                    text = text or ""
                    ends = sections_of(text)
                    found.append((ends, *attributed(token_ends(text, encoder, sizes), ends)))
                sizes_of = [len(f[0]) for f in found]
                ids = part.column(0).take(pa.array(np.repeat(np.arange(len(found)), sizes_of)))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in sizes_of])),
                        pa.array(np.concatenate([np.concatenate([[0], f[0][:-1]]) for f in found])),
                        pa.array(np.concatenate([f[0] for f in found])),
                        pa.array(np.concatenate([f[1] for f in found])),
                        pa.array(np.concatenate([f[2] for f in found])),
                    ],
                    names=["doc_id", *(f.split()[0] for f in ATTRIBUTED.split(", "))],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, {ATTRIBUTED}")
