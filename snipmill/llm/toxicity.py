"""Toxicity by a factorization machine over hashed terms (Rendle, 2010).

A text is the set of its terms: words in lower case without punctuation around
them, and their first three to seven letters, hashed into 2^30 slots. The machine adds a weight per term and, for every
two terms of a text, the product of their factor vectors, so it can learn that two
terms together say more, or less, than each alone. All pairs of a text cost one
pass over its terms: half of (sum of vectors)^2 minus the sum of squares.

Training takes a bounded sample of labelled rows (``Machine.sample_rows``), those
with the smallest hashes of their ids. Spark finds and hashes them and counts each
slot. Kept are slots that go with the label by themselves, by chi-square, and slots
that do so only in pairs: the difference that one makes to the share of ones depends
on the other. Such pairs are sought among the slots that part the rows most evenly
and those that tell most alone. Only places of rows in these lists come to the
driver, a number that the parameters bound, however long texts are. Scoring reads
all whole texts.

Results, defined for every input: a null text is an empty text; an empty text gets
the bias alone. Labels of rows with a null id or label are left out. Of repeated
labels of an id the largest counts, of repeated texts of an id the smallest is
learned from. Without rows of both labels the score is the share of ones, or 0.
Every row is scored alone; labels, other columns and ids are never inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from snipmill.llm.common import Numbering, sampled, texts_of
from snipmill.session import materialise

SLOT_BITS = 30
BEGINS = range(3, 8)  # lengths of the begins of words that are terms too
PART = 1 << 23
AROUND = b".,;:!?\"'()[]{}<>*#$%&|-_"


@dataclass(frozen=True)
class Machine:
    """Parameters of training."""

    sample_rows: int = 12_000
    terms: int = 2_048  # slots kept, by chi-square
    least_rows: int = 4  # sample rows in which a kept slot occurs
    least_chi: float = 10.8  # its chi-square, which chance exceeds once in a thousand slots
    even_terms: int = 1_024  # slots searched for pairs: those that part the rows most evenly,
    told_terms: int = 512  # and those of the largest chi-square
    pairs: int = 512  # pairs kept
    least_cell: float = 4.0  # rows of either label to expect in each of the four cases of a pair
    least_pair_chi: float = 40.0  # chi-square of a kept pair, high as there are a million pairs
    factors: int = 6
    rounds: int = 12
    batch: int = 128
    rate: float = 0.05
    shrink: float = 2e-4
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """What scoring needs: chosen slots in order, bias, weights and factors."""

    slots: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def places(self, slots: np.ndarray) -> np.ndarray:
        """Place of each slot among the chosen ones, or -1."""
        if not len(self.slots):
            return np.full(slots.shape, -1)
        found = np.minimum(np.searchsorted(self.slots, slots), len(self.slots) - 1)
        return np.where(self.slots[found] == slots, found, -1)

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        sizes = [len(s) for s in sets]
        out = np.full(len(sets), self.bias, np.float64)
        terms = np.concatenate([*sets, np.empty(0, np.int64)]).astype(np.int64)
        if len(terms):
            full = np.flatnonzero(sizes)
            starts = np.cumsum([0, *sizes])[full]
            vectors = self.factors[terms]
            sums = np.add.reduceat(vectors, starts)
            squares = np.add.reduceat((vectors**2).sum(axis=1), starts)
            out[full] += np.add.reduceat(self.weights[terms], starts)
            out[full] += ((sums**2).sum(axis=1) - squares) / 2
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def _slots(word: bytes) -> list[int]:
    """Slots of a word and its begins; what does not exist is -1."""
    bare = word.strip(AROUND)
    if not bare:
        return [-1] * (1 + len(BEGINS))
    letters = bare.decode("utf-8", "replace")
    mask = (1 << SLOT_BITS) - 1
    out = [xxhash.xxh32_intdigest(bare) & mask]
    for k in BEGINS:
        begin = letters[:k].encode("utf-8", "replace")
        out.append(xxhash.xxh32_intdigest(begin, k) & mask if len(letters) > k else -1)
    return out


def slot_sets(texts: list[bytes], model: Model | None = None) -> list[np.ndarray]:
    """Distinct slots of each text, or their places in a model; part by part, so that
    no more than the words of ``PART`` bytes, or of one text, are held at once."""
    out, at = [], 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and size < PART:
            size += len(texts[stop])
            stop += 1
        out += _slot_sets(texts[at:stop], model)
        at = stop
    return out


def _slot_sets(texts: list[bytes], model: Model | None) -> list[np.ndarray]:
    numbers = Numbering()
    rows = []
    for text in texts:
        words = text.lower().split()
        rows.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
    n = len(numbers) * (1 + len(BEGINS))
    known = np.fromiter((s for w in numbers for s in _slots(w)), np.int64, n)
    known = known.reshape(-1, 1 + len(BEGINS))
    if model:
        known = model.places(known)
    some = (known >= 0).any(axis=1)
    found = (np.unique(known[r[some[r]]]) for r in rows)
    return [f[f >= 0] for f in found]


@F.arrow_udf(ArrayType(IntegerType()))
def slots(texts: pa.Array) -> pa.Array:
    """Distinct slots of a text."""
    return pa.array([s.astype(np.int32) for s in slot_sets(texts_of(texts))], pa.list_(pa.int32()))


def places_in(known: np.ndarray):
    """Function from a column of slots to their places in a sorted list of slots."""
    model = Model(known, 0.0, np.zeros(1), np.zeros((1, 1)))

    @F.arrow_udf(ArrayType(IntegerType()))
    def places(lists: pa.Array) -> pa.Array:
        found = model.places(lists.flatten().to_numpy(zero_copy_only=False))
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        own = np.repeat(np.arange(len(sizes)), sizes)[found >= 0]
        ends = np.cumsum(np.bincount(own, minlength=len(sizes)))
        return pa.ListArray.from_arrays(
            pa.array([0, *ends], pa.int32()), pa.array(found[found >= 0], pa.int32())
        )

    return places


def counted_slots(rows: DataFrame, n: int, ones: int, machine: Machine) -> tuple[np.ndarray, ...]:
    """Slots by chi-square with the label, best first, and those that part the rows
    most evenly. ``rows`` has ``label`` and ``slots``."""
    hit = F.col("label").cast("double")
    counts = (
        rows.select((F.col("label") > 0).cast("int").alias("label"), F.explode("slots").alias("slot"))
        .groupBy("slot")
        .agg(F.count("*").alias("n"), F.sum(hit).alias("hits"))
        .where(F.col("n") >= machine.least_rows)
    )
    expected = F.col("n") * (ones / n)
    spread = expected * (1 - ones / n) * (1 - F.col("n") / n)
    chi = F.when(spread > 0, (F.col("hits") - expected) ** 2 / spread).otherwise(0.0)
    told = counts.withColumn("score", chi).where(F.col("score") >= machine.least_chi)
    even = counts.withColumn("score", (F.col("n") * (n - F.col("n"))).cast("double"))
    lists = [
        df.orderBy(F.desc("score"), "slot").limit(most).select(F.lit(i).alias("i"), "score", "slot")
        for i, (df, most) in enumerate(((told, machine.terms), (even, machine.even_terms)))
    ]
    best = lists[0].unionByName(lists[1]).toPandas().sort_values(["i", "score", "slot"], ascending=[True, False, True])
    return tuple(best["slot"][best["i"] == i].to_numpy(np.int64) for i in (0, 1))


def pairing(sets: list[np.ndarray], labels: np.ndarray, size: int, machine: Machine) -> np.ndarray:
    """Which of ``size`` terms belong to the kept pairs.

    The four cases of a pair, both terms, one, the other, none, have four shares of
    ones. If terms only add up, share(both) - share(one) - share(other) + share(none)
    is 0; its square over its variance is a chi-square of one degree of freedom.
    """
    n, share = len(sets), labels.mean()
    rows, hits = np.zeros((size, size), np.float32), np.zeros((size, size), np.float32)
    for at in range(0, n, 1000):
        x = np.zeros((min(1000, n - at), size), np.float32)
        for i, s in enumerate(sets[at : at + 1000]):
            x[i, s] = 1
        rows += x.T @ x
        x_ones = x[labels[at : at + 1000] > 0]
        hits += x_ones.T @ x_ones
    n_own, k_own = np.diag(rows).astype(float), np.diag(hits).astype(float)
    least = machine.least_cell / min(share, 1 - share)
    best = []
    for i in range(size - 1):
        n11, k11 = rows[i, i + 1 :].astype(float), hits[i, i + 1 :].astype(float)
        n10, k10 = n_own[i] - n11, k_own[i] - k11
        n01, k01 = n_own[i + 1 :] - n11, k_own[i + 1 :] - k11
        n00, k00 = n - n11 - n10 - n01, labels.sum() - k11 - k10 - k01
        full = np.flatnonzero(np.minimum(np.minimum(n11, n10), np.minimum(n01, n00)) >= least)
        n11, n10, n01, n00 = n11[full], n10[full], n01[full], n00[full]
        contrast = k11[full] / n11 - k10[full] / n10 - k01[full] / n01 + k00[full] / n00
        chi = contrast**2 / (share * (1 - share) * (1 / n11 + 1 / n10 + 1 / n01 + 1 / n00))
        over = chi >= machine.least_pair_chi
        best += zip(-chi[over], np.full(over.sum(), i), full[over] + i + 1)
    kept = sorted(best)[: machine.pairs]
    return np.unique(np.array([(i, j) for _, i, j in kept], np.int64))


def constant(share: float, machine: Machine) -> Model:
    """The model when there are no rows of both labels."""
    bias = -500.0 if share == 0 else 500.0
    return Model(np.empty(0, np.int64), bias, np.zeros(1), np.zeros((1, machine.factors)))


def fit(best: np.ndarray, rows: list[np.ndarray], labels: np.ndarray, machine: Machine = Machine()) -> Model:
    """Train by AdaGrad on the logistic loss; ``rows`` hold places in the slots ``best``."""
    share = float(labels.mean())
    random = np.random.default_rng(machine.seed)
    w = np.zeros(len(best))
    v = random.normal(0, 0.02, (len(best), machine.factors))
    b, gb, gw, gv = np.log(share / (1 - share)), 1e-8, np.full(len(w), 1e-8), np.full(v.shape, 1e-8)
    for _ in range(machine.rounds):
        order = random.permutation(len(rows))
        for at in range(0, len(order), machine.batch):
            own = order[at : at + machine.batch]
            x = np.zeros((len(own), len(best)))
            for i, r in enumerate(own):
                x[i, rows[r]] = 1
            xv = x @ v
            z = b + x @ w + ((xv**2).sum(axis=1) - x @ (v**2).sum(axis=1)) / 2
            error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels[own]) / len(own)
            dw = x.T @ error + machine.shrink * w
            dv = x.T @ (error[:, None] * xv) - v * (x.T @ error)[:, None] + machine.shrink * v
            db = error.sum()
            gb, gw, gv = gb + db**2, gw + dw**2, gv + dv**2
            b -= machine.rate * db / gb**0.5
            w -= machine.rate * dw / gw**0.5
            v -= machine.rate * dv / gv**0.5
    return Model(best, float(b), w, v)


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    machine: Machine = Machine(),
) -> Model:
    """A model of the labelled rows for which ``learn_from``, a condition on the
    column ``doc_id``, is true."""
    labelled = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & learn_from)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # At most ``sample_rows`` rows of an id and a label: small enough for every executor.
    labelled = labelled.withColumn("draw", F.xxhash64("doc_id"))
    sample = sampled(labelled, "draw", machine.sample_rows).drop("draw")
    rows = materialise(
        texts.join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "label", slots("text").alias("slots")),
        "labelled",
    )
    total = rows.agg(F.count("*").alias("n"), F.count_if(F.col("label") > 0).alias("ones")).head()
    if not 0 < total.ones < total.n:
        return constant(total.ones / max(total.n, 1), machine)
    told, even = counted_slots(rows, total.n, total.ones, machine)
    known = np.unique(np.concatenate([told, even]))
    found = (
        rows.select("doc_id", "label", places_in(known)("slots").alias("places")).orderBy("doc_id").toArrow()
    )
    labels = (found["label"].to_numpy() > 0).astype(np.float64)
    lists = found["places"].combine_chunks()
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))[:-1]
    sets = np.split(lists.flatten().to_numpy(zero_copy_only=False), ends)

    searched = np.unique(np.concatenate([told[: machine.told_terms], even]))
    paired = searched[pairing(_within(sets, known, searched), labels, len(searched), machine)]
    best = np.union1d(told, paired)
    return fit(best, _within(sets, known, best), labels, machine)


def _within(sets: list[np.ndarray], known: np.ndarray, some: np.ndarray) -> list[np.ndarray]:
    """Sets of places in ``known`` as places in a part of it."""
    place = np.full(len(known), -1)
    place[np.searchsorted(known, some)] = np.arange(len(some))
    return [p[p >= 0] for p in (place[s] for s in sets)]


def scorer(spark, model: Model):
    """Function from a text column to its score between 0 and 1."""
    shared = spark.sparkContext.broadcast(model)  # its size follows from the parameters

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        known = shared.value
        return pa.array(known.scores(slot_sets(texts_of(texts), known)), pa.float64())

    return lambda text: score(text.cast("string"))
