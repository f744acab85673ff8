"""Quality by a factorisation machine over words, structure and metadata (Rendle, 2010).

A text is a sparse vector with three kinds of entries:

* words in lower case without what is around them, and apart from these the marks and
  the case of a word, each hashed into one of ``WORD_SLOTS`` places, with the logarithm
  of their counts, scaled to length 1;
* statistics of its structure: shares of kinds of characters, of repeated lines and
  words, lengths of words and lines;
* metadata: the stored number of characters, and whether it is there.

The machine adds a weight per entry and, for every two entries, the product of their
factor vectors, so the same word can count otherwise in an odd structure. All pairs
cost one pass over the entries: half of (sum of vectors)^2 minus the sum of squares.

Training takes a bounded sample of labelled rows (``Training.sample_rows``), those with
the smallest hashes of their ids. Entries are made in the tasks, so the driver gets at
most ``sample_rows`` times ``WORD_SLOTS`` numbers, however long the texts are. No slot is
chosen by its own weight for the label, so pairs that matter only together are learned.
Scoring reads all whole texts, each by itself.

Results, defined for every input: a null text is an empty text, which is scored by the
bias, its structure and metadata; null, negative and absurd metadata are none. Labels of
rows with a null id or label are left out; of repeated labels of an id the largest
counts, of repeated texts of an id one (the smallest digest) is learned from. Without
rows of both labels the score is the share of ones, or 0. Order, ids, language, source
and labels are never inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, IntegerType, StructField, StructType

from snipmill.llm.common import Numbering, sampled, texts_of

WORD_SLOTS = 4_096
PART = 1 << 23  # bytes of text that are cut into words at once
AROUND = bytes(c for c in range(33, 127) if not chr(c).isalnum())
STATISTICS = 14
METADATA = 2
SIZE = WORD_SLOTS + STATISTICS + METADATA

ENTRIES = StructType([
    StructField("places", ArrayType(IntegerType())), StructField("values", ArrayType(FloatType())),
])


@dataclass(frozen=True)
class Training:
    """Parameters of training."""

    sample_rows: int = 8_000
    factors: int = 6
    rounds: int = 16
    batch: int = 64
    rate: float = 0.05
    shrink: float = 1e-5
    seed: int = 12


@dataclass(frozen=True)
class Machine:
    """Bias, weights and factors of all entries."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Score of each row, given as places and values; linear in their number."""
        out = np.full(len(rows), self.bias)
        for i, (places, values) in enumerate(rows):
            vectors = self.factors[places] * values[:, None]
            out[i] += self.weights[places] @ values
            out[i] += ((vectors.sum(axis=0) ** 2).sum() - (vectors**2).sum()) / 2
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def _word_places(word: bytes) -> tuple[int, int]:
    """Places of a word and of its marks and case."""
    bare = word.strip(AROUND)
    at = word.find(bare) if bare else 0
    case = b"U" if bare.isupper() else b"T" if bare[:1].isupper() else b"l"
    marks = word[:at] + case + word[at + len(bare) :][:4]
    return (
        xxhash.xxh32_intdigest(bare.lower(), 1) % WORD_SLOTS,
        xxhash.xxh32_intdigest(marks, 2) % WORD_SLOTS,
    )


_KINDS = np.zeros((256, 7))
for _byte in range(256):
    _char = chr(_byte)
    _kind = (
        6 if _byte > 127 else 0 if "a" <= _char <= "z" else 1 if "A" <= _char <= "Z"
        else 2 if _char.isdigit() else 3 if _char == "\n" else 4 if _char.isspace() else 5
    )
    _KINDS[_byte, _kind] = 1


def _structure(text: bytes, words: int, distinct: int) -> list[float]:
    """Statistics of a text, most of them between 0 and 1."""
    size = max(len(text), 1)
    kinds = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _KINDS / size
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters = kinds[0] + kinds[1]
    return [
        *kinds.tolist(),
        kinds[1] / letters if letters else 0.0,
        min(len(text) / max(words, 1) / 10, 3.0),
        np.log1p(words) / 10,
        distinct / max(words, 1),
        1 - len(set(lines)) / max(len(lines), 1),
        np.log1p(len(text) / max(len(lines), 1)) / 10,
        float(not words),
    ]


def _metadata(n_chars: float | None) -> list[float]:
    if n_chars is None or not 0 <= n_chars < 1e15:
        return [0.0, 1.0]
    return [float(np.log1p(n_chars)) / 10, 0.0]


def _part_entries(texts: list[bytes], n_chars: list) -> list[tuple[np.ndarray, np.ndarray]]:
    numbers = Numbering()
    rows = []
    for text in texts:
        words = text.split()
        rows.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
    places = np.array([_word_places(w) for w in numbers], np.int64).reshape(-1, 2)
    last = np.arange(WORD_SLOTS, SIZE)
    out = []
    for text, row, chars in zip(texts, rows, n_chars):
        counts = np.bincount(places[row].ravel(), minlength=WORD_SLOTS)
        at = np.flatnonzero(counts)
        values = np.log1p(counts[at])
        values /= max(np.sqrt((values**2).sum()), 1e-12)
        more = _structure(text, len(row), len(np.unique(row))) + _metadata(chars)
        out.append((np.concatenate([at, last]), np.concatenate([values, more])))
    return out


def entries_of(texts: list[bytes], n_chars: list):
    """Entries of each text as places and values, in parts of about ``PART`` bytes."""
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and size < PART:
            size += len(texts[stop])
            stop += 1
        yield _part_entries(texts[at:stop], n_chars[at:stop])
        at = stop


@F.arrow_udf(ENTRIES)
def entries(texts: pa.Array, n_chars: pa.Array) -> pa.Array:
    """Entries of each text."""
    rows = [r for part in entries_of(texts_of(texts), n_chars.to_pylist()) for r in part]
    places = pa.array([p.astype(np.int32) for p, _ in rows], pa.list_(pa.int32()))
    values = pa.array([v.astype(np.float32) for _, v in rows], pa.list_(pa.float32()))
    return pa.StructArray.from_arrays([places, values], ["places", "values"])


def fit(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, training: Training = Training()
) -> Machine:
    """Train by AdaGrad on the logistic loss."""
    share = float(labels.mean()) if len(labels) else 0.0
    w, k = np.zeros(SIZE), training.factors
    if not 0 < share < 1:
        return Machine(500.0 if share else -500.0, w, np.zeros((SIZE, k)))
    random = np.random.default_rng(training.seed)
    v = random.normal(0, 0.05, (SIZE, k))
    b, gb = np.log(share / (1 - share)), 1e-8
    gw, gv = np.full(w.shape, 1e-8), np.full(v.shape, 1e-8)
    for _ in range(training.rounds):
        order = random.permutation(len(rows))
        for at in range(0, len(order), training.batch):
            own = order[at : at + training.batch]
            x = np.zeros((len(own), SIZE))
            for i, r in enumerate(own):
                x[i, rows[r][0]] = rows[r][1]
            used = np.flatnonzero(x.any(axis=0))
            x, vu, wu = x[:, used], v[used], w[used]
            sums = x @ vu
            z = b + x @ wu + ((sums**2).sum(axis=1) - (x**2) @ (vu**2).sum(axis=1)) / 2
            error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels[own]) / len(own)
            dw = x.T @ error + training.shrink * wu
            dv = x.T @ (error[:, None] * sums) - vu * ((x**2).T @ error)[:, None] + training.shrink * vu
            gb += error.sum() ** 2
            gw[used] += dw**2
            gv[used] += dv**2
            b -= training.rate * error.sum() / gb**0.5
            w[used] -= training.rate * dw / gw[used] ** 0.5
            v[used] -= training.rate * dv / gv[used] ** 0.5
    return Machine(float(b), w, v)


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    chars_col: str = "n_chars",
    label_col: str = "quality",
    training: Training = Training(),
) -> Machine:
    """A machine of the labelled rows for which ``learn_from``, a condition on the
    column ``doc_id``, is true."""
    labelled = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & learn_from)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .withColumn("draw", F.xxhash64("doc_id"))
    )
    texts = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(chars_col).cast("double").alias("n_chars"),
    )
    # At most ``sample_rows`` rows of an id and a label: small enough for every executor.
    sample = F.broadcast(sampled(labelled, "draw", training.sample_rows).drop("draw"))
    order = F.struct(F.sha2(F.coalesce("text", F.lit("")), 256), "n_chars")
    rows = (
        texts.join(sample, "doc_id")
        .select("doc_id", "label", entries("text", "n_chars").alias("entries"), order.alias("order"))
        .groupBy("doc_id", "label")
        .agg(F.min_by("entries", "order").alias("entries"))
        .orderBy("doc_id")
        .select("label", "entries.places", "entries.values")
        .toArrow()
    )
    ends = np.cumsum(rows["places"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False))
    flat = (
        rows[name].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        for name in ("places", "values")
    )
    parts = list(zip(*(np.split(x, ends[:-1]) for x in flat))) if len(rows) else []
    return fit(parts, (rows["label"].to_numpy() > 0).astype(np.float64), training)


def scorer(spark: SparkSession, machine: Machine):
    """Function from a text and its stored length to a score between 0 and 1."""
    shared = spark.sparkContext.broadcast(machine)  # its size follows from the parameters

    @F.arrow_udf("double")
    def score(texts: pa.Array, n_chars: pa.Array) -> pa.Array:
        own = entries_of(texts_of(texts), n_chars.to_pylist())
        found = [shared.value.scores(part) for part in own]
        return pa.array(np.concatenate([*found, np.empty(0)]), pa.float64())

    return lambda text, n_chars: score(text.cast("string"), n_chars.cast("double"))
