import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from snipmill.llm import quality_model as q
from snipmill.llm.common import fold, table
from snipmill.llm.queries import op12_quality_machine

SF = "/root/testdata/sf0.01"
KNOWN = "doc_id bigint, quality int"


def corpus(n, good, seed=1):
    """Texts with one of two terms, both or neither; ``good`` tells the label."""
    draw = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        a, b = draw.random() < 0.5, draw.random() < 0.5
        text = [f"w{draw.randrange(60)}" for _ in range(12)] + ["zeta"] * a + ["Omega,"] * b
        draw.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, int(good(a, b))))
    return rows, labels


def scored(df, machine, spark):
    return df.select("doc_id", q.scorer(spark, machine)(F.col("text"), F.col("n_chars")).alias("score")).collect()


@pytest.mark.parametrize("good", [lambda a, b: a != b, lambda a, b: a == b, lambda a, b: a and b])
def test_pairs_of_words_are_learned(spark, documents, good):
    """Also where each word alone tells nothing."""
    rows, labels = corpus(4000, good)
    known = spark.createDataFrame(labels, KNOWN)
    training = q.Training(rounds=40, batch=32, rate=0.1)
    machine = q.train(documents(rows), known, fold(F.col("doc_id")) != 0, training=training)
    late = [r for r in scored(documents(rows).where(fold(F.col("doc_id")) == 0), machine, spark)]
    right = [(r.score >= 0.5) == bool(labels[r.doc_id][1]) for r in late]
    assert len(right) > 700 and sum(right) / len(right) > 0.95


def test_scores_equal_all_pairs():
    draw = np.random.default_rng(2)
    machine = q.Machine(-0.3, draw.normal(size=q.SIZE) / 9, draw.normal(size=(q.SIZE, 4)) / 9)
    texts = [b"", b"One two, two!", "größe *** x\n\nx y".encode() * 30]
    (rows,) = q.entries_of(texts, [None, 13, 2.0])
    for (places, values), found in zip(rows, machine.scores(rows)):
        z = machine.bias + machine.weights[places] @ values
        for i, a in enumerate(places):
            for j in range(i + 1, len(places)):
                z += machine.factors[a] @ machine.factors[places[j]] * values[i] * values[j]
        assert abs(found - 1 / (1 + np.exp(-z))) < 1e-9


def test_labels_of_the_held_out_fold_are_not_used(spark, documents):
    rows, labels = corpus(300, lambda a, b: a)
    late = fold(F.col("doc_id")) == 0
    known = spark.createDataFrame(labels, KNOWN)
    turned = known.withColumn("quality", F.when(late, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (q.train(documents(rows), x, ~late) for x in (known, turned))
    assert a.bias == b.bias and (a.weights == b.weights).all() and (a.factors == b.factors).all()


def test_sample_is_bounded(spark, documents, monkeypatch):
    rows, labels = corpus(300, lambda a, b: a)
    seen = []
    monkeypatch.setattr(q, "fit", lambda rows, labels, training: seen.append((len(rows), len(labels))))
    q.train(documents(rows), spark.createDataFrame(labels, KNOWN), F.lit(True), training=q.Training(sample_rows=50))
    assert seen == [(50, 50)]


def test_odd_rows(spark, documents, odd_rows):
    df = documents(odd_rows)
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 0), (None, 1), (5, None), (99, 1)], KNOWN)
    machine = q.train(df, labels, F.lit(True))
    found = scored(df, machine, spark)
    scores = [r.score for r in found]
    assert len(found) == len(odd_rows) and all(0 <= s <= 1 for s in scores)
    assert scores[0] == scores[1] and scores[3] == scores[4] == scores[6]
    for some, wanted in ((labels.limit(0), 0.0), (labels.where("quality = 1"), 1.0)):
        machine = q.train(df, some, F.lit(True))
        assert all(abs(r.score - wanted) < 1e-9 for r in scored(df, machine, spark))
    assert q.train(documents([]), labels, F.lit(True)).bias < 0
    assert scored(documents([]), machine, spark) == []


def test_metadata_out_of_range_is_none():
    assert q._metadata(None) == q._metadata(-1.0) == q._metadata(float("nan")) == q._metadata(1e20)
    assert q._metadata(0.0) != q._metadata(None)


def test_held_out_documents(spark):
    found = op12_quality_machine(spark, SF).join(table(spark, SF, "labels"), "doc_id")
    rows = found.where("held_out").select("predicted", "quality").collect()
    assert len(rows) > 50 and sum(r.predicted == r.quality for r in rows) / len(rows) >= 0.9
    assert all(r.predicted for r in rows if r.quality)
