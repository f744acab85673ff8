import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from snipmill.llm import toxicity
from snipmill.llm.common import fold
from snipmill.llm.toxicity import Machine


BOTH, ONE, EQUAL = (3,), (1, 2), (0, 3)


def corpus(n, seed=1, toxic=BOTH):
    """Toxic are texts that have an insult and a group, exactly one, or both or neither."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        text = [draw.choice(words) for _ in range(30)]
        kind = draw.randrange(4)
        text += ["Blorgish!"] * (kind in (1, 3)) + ["zorplings,"] * (kind in (2, 3))
        draw.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, int(kind in toxic)))
    return rows, labels


@pytest.mark.parametrize("toxic", [BOTH, ONE, EQUAL])
def test_pairs_of_terms_are_learned(spark, documents, toxic):
    rows, labels = corpus(1500, toxic=toxic)
    df = documents(rows)
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.train(df, known, fold(F.col("doc_id")) != 0)
    scores = df.select("doc_id", toxicity.scorer(spark, model)(F.col("text")).alias("score"))
    found = scores.withColumn("late", fold(F.col("doc_id")) == 0).collect()
    late = [(r.score >= 0.5) == bool(labels[r.doc_id][1]) for r in found if r.late]
    assert len(late) > 200 and sum(late) / len(late) > 0.95


def test_labels_of_the_held_out_fold_are_not_used(spark, documents):
    rows, labels = corpus(400)
    df = documents(rows)
    late = fold(F.col("doc_id")) == 0
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    turned = known.withColumn("toxic", F.when(late, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.train(df, x, ~late) for x in (known, turned))
    assert (a.slots == b.slots).all() and (a.weights == b.weights).all() and a.bias == b.bias


def test_pairs_equal_brute_force():
    draw = np.random.default_rng(4)
    machine = Machine(least_cell=2.0, least_pair_chi=6.0)
    x = draw.random((2300, 12)) < 0.3
    x[:, 5] = x[:, 4]
    labels = (draw.random(2300) < np.where(x[:, 1] ^ x[:, 7], 0.6, 0.3)).astype(float)
    share, wanted = labels.mean(), set()
    for a in range(12):
        for b in range(a):
            cells = [labels[(x[:, a] == i) & (x[:, b] == j)] for i in (0, 1) for j in (0, 1)]
            if min(map(len, cells)) * min(share, 1 - share) >= machine.least_cell:
                p00, p01, p10, p11 = (c.mean() for c in cells)
                spread = share * (1 - share) * sum(1 / len(c) for c in cells)
                if (p11 - p10 - p01 + p00) ** 2 / spread >= machine.least_pair_chi:
                    wanted |= {a, b}
    sets = [np.flatnonzero(r) for r in x]
    assert {1, 7} <= wanted and set(toxicity.pairing(sets, labels, 12, machine)) == wanted
    assert list(toxicity.pairing(sets, labels, 12, Machine(pairs=1))) == [1, 7]
    assert len(toxicity.pairing(sets, draw.permutation(labels), 12, Machine())) == 0


def test_scores_equal_all_pairs():
    draw = np.random.default_rng(2)
    model = toxicity.Model(np.arange(30), -0.3, draw.normal(size=30), draw.normal(size=(30, 4)))
    sets = [np.unique(draw.integers(0, 30, n)) for n in (1, 0, 5, 12)]
    for s, found in zip(sets, model.scores(sets)):
        z = model.bias + model.weights[s].sum()
        z += sum(model.factors[a] @ model.factors[b] for i, a in enumerate(s) for b in s[i + 1 :])
        assert abs(found - 1 / (1 + np.exp(-z))) < 1e-9


def test_terms_ignore_case_punctuation_and_order():
    a, b = toxicity.slot_sets([b"Idiot! the", b"the (idiot)"])
    assert (a == b).all()
    x, y = toxicity.slot_sets(["größer".encode(), "größe".encode()])
    assert len(np.intersect1d(x, y)) >= 2
    assert [len(s) for s in toxicity.slot_sets([b"", b" ... "])] == [0, 0]


def test_odd_rows(spark, documents, odd_rows):
    df = documents(odd_rows)
    labels = spark.createDataFrame(
        [(4, 1), (4, 0), (6, 0), (None, 1), (5, None), (99, 1)], "doc_id bigint, toxic int"
    )
    model = toxicity.train(df, labels, F.lit(True), machine=Machine(least_rows=1))
    scores = [r.s for r in df.select(toxicity.scorer(spark, model)(F.col("text")).alias("s")).collect()]
    assert len(scores) == len(odd_rows) and all(0 <= s <= 1 for s in scores)
    assert scores[0] == scores[1] == scores[2] and scores[3] == scores[4] == scores[6]
    for some, wanted in ((labels.limit(0), 0.0), (labels.where("toxic = 1"), 1.0)):
        model = toxicity.train(df, some, F.lit(True))
        (row,) = df.where("doc_id = 2").select(toxicity.scorer(spark, model)(F.col("text")).alias("s")).collect()
        assert abs(row.s - wanted) < 1e-9
    assert toxicity.train(documents([]), labels, F.lit(True)).bias < 0


def test_sample_is_bounded(spark, documents):
    rows, labels = corpus(300)
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.train(documents(rows), known, F.lit(True), machine=Machine(sample_rows=50, terms=20, pairs=3))
    assert len(model.slots) <= 26
