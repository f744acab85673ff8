"""Quality rules by compression: zstandard ratios of whole texts and of fixed chunks.

A ratio is bytes before over bytes after compression. Prose lies in a band:
repetitive text compresses much better, random or encrypted text hardly at all.
Short texts compress less, so the band depends on the length. Long texts are also
cut into chunks of a fixed size, so that a text with much junk inside fails even
if its whole looks ordinary.

Results, defined for every input: a null text is an empty text; an empty text has
no words, no ratio (null), and fails. Every text is judged alone and as a whole,
so ties, repeated rows and further columns do not matter. Chunks are cut by
bytes and may split a letter, which changes no ratio by more than a few bytes.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

from snipmill.llm.common import Numbering, texts_of

SYMBOLS = b"[#*$%&|<>]"[1:-1]

FIGURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, ratio double, n_chunks bigint, "
    "chunks_outside bigint, kept boolean"
)


@dataclass(frozen=True)
class Bands:
    """Limits of the ratios.

    ``whole`` has the limits by length: (bytes from which it holds, lowest, highest).
    ``chunk`` has those of one chunk of ``chunk_bytes``; a shorter last chunk counts
    if it has at least half of that, and only texts of two chunks or more are cut.
    A text fails if a share over ``most_outside`` of its chunks is outside.
    """

    whole: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 2.6),
        (256, 1.1, 3.0),
        (512, 1.2, 3.3),
        (2048, 1.4, 3.6),
        (8192, 1.5, 4.5),
    )
    chunk: tuple[float, float] = (1.3, 4.0)
    chunk_bytes: int = 2048
    most_outside: float = 0.25
    level: int = 3

    def __post_init__(self):
        starts = [w[0] for w in self.whole]
        if starts[0] != 0 or any(a >= b for a, b in pairwise(starts)):
            raise ValueError("bands must start at 0 and be in order of length")

    def of_length(self, n: int) -> tuple[float, float]:
        return next((low, high) for start, low, high in reversed(self.whole) if n >= start)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which the text has twice or more."""
    if len(words) < 4:
        return 0
    numbers = Numbering()
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    first = ids[:-2] * len(numbers) + ids[1:-1]
    if len(numbers) >= 1 << 20:  # three numbers would not fit
        first = np.unique(first, return_inverse=True)[1]
    _, window, times = np.unique(
        first * len(numbers) + ids[2:], return_inverse=True, return_counts=True
    )
    again = times[window] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [x for x in text.split(b"\n") if x.split()]
    return len(lines) - len(set(lines))


def ratios(text: bytes, bands: Bands, compressor) -> tuple[float | None, list[float]]:
    """Ratio of the whole text and of its chunks."""
    if not text:
        return None, []
    whole = len(text) / len(compressor.compress(text))
    size = bands.chunk_bytes
    if len(text) < 2 * size:
        return whole, []
    chunks = (text[i : i + size] for i in range(0, len(text) - size // 2 + 1, size))
    return whole, [len(c) / len(compressor.compress(c)) for c in chunks]


def figures(text: bytes, bands: Bands, compressor) -> tuple:
    """The fields of ``FIGURES`` for one text."""
    words = text.split()
    n = len(words)
    repeated = repeat_words(words)
    failed = n < 50 or 100 * repeated > 50 * n
    whole, chunks = ratios(text, bands, compressor)
    low, high = bands.of_length(len(text))
    outside = sum(not bands.chunk[0] <= c <= bands.chunk[1] for c in chunks)
    inside = (
        whole is not None and low <= whole <= high and outside <= bands.most_outside * len(chunks)
    )
    return (
        n,
        len(b"".join(words).decode("utf-8", "replace")),
        len(text) - len(text.translate(None, SYMBOLS)),
        duplicate_lines(text),
        repeated,
        failed,
        whole,
        len(chunks),
        outside,
        inside and not failed,
    )


def quality(bands: Bands = Bands()):
    """Function from a text column to a struct of ``FIGURES``; ``kept`` is the verdict."""

    @F.arrow_udf(FIGURES)
    def judged(texts: pa.Array) -> pa.Array:
        compressor = zstandard.ZstdCompressor(level=bands.level)
        rows = [figures(t, bands, compressor) for t in texts_of(texts)]
        names = [f.split()[0] for f in FIGURES.split(", ")]
        kinds = {"bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
        types = [kinds[f.split()[1]] for f in FIGURES.split(", ")]
        columns = zip(*rows) if rows else [()] * len(names)
        arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
        return pa.StructArray.from_arrays(arrays, names=names)

    return lambda text: judged(text.cast("string"))
