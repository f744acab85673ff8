"""Fixed-length sequences, labels and evaluation."""

import math

import pytest
from pyspark.sql import functions as F

from snipmill.operators.evaluation import evaluation_summary
from snipmill.operators.sequences import labels, pad_id, with_sequences


def test_sequences(spark):
    frame = spark.createDataFrame(
        [(0, [5, 6]), (1, [1, 2, 3, 4, 5]), (2, []), (3, None), (4, [7, 0, 9, 8])],
        "i int, token_ids array<int>",
    )
    found = with_sequences(frame, 0, 9, length=4).orderBy("i").collect()
    assert [(r.input_ids, r.attention_mask) for r in found] == [
        ([5, 6, 0, 0], [1, 1, 0, 0]),
        ([1, 2, 3, 4], [1, 1, 1, 1]),
        ([9, 0, 0, 0], [1, 0, 0, 0]),
        ([9, 9, 9, 9], [0, 0, 0, 0]),
        ([7, 0, 9, 8], [1, 1, 1, 1]),
    ]
    default = with_sequences(frame, 0, None).orderBy("i").collect()
    assert all(len(r.input_ids) == len(r.attention_mask) == 512 for r in default)
    assert default[3].input_ids == [0] * 512


def test_labels_mask_the_pad_id_even_for_real_tokens(column):
    rows = [([7, 0, 9, 0],), ([0],)]
    assert column(rows, "ids array<int>", labels(F.col("ids"), 0)) == [
        [7, -100, 9, -100], [-100],
    ]


def test_pad_id():
    assert pad_id(3, 2, 100) == 3
    assert pad_id(0, 2, 100) == 0
    assert pad_id(None, 2, 100) == 2
    assert pad_id(None, None, 100) == 100


SCHEMA = "phase string, loss double, label array<int>, pred array<int>, attention array<int>"


def test_evaluation(spark):
    frame = spark.createDataFrame(
        [
            ("a", 1.0, [1, 2, 3, 0], [1, 9, 3, 0], [1, 1, 1, 0]),
            ("a", None, [4, 5, 0, 0], [5, 5, 0, 0], [1, 1, 0, 0]),
            ("b", 3.0, [1, 1, 0, 0], [1, 1, 0, 0], [0, 0, 0, 0]),
        ],
        SCHEMA,
    )
    a, b = evaluation_summary(frame, "phase").orderBy("phase").collect()
    assert (a.batches, a.target_tokens, a.correct_tokens) == (2, 5, 3)
    assert a.avg_loss == 0.5 and a.accuracy == 0.6
    assert b.avg_loss == 3.0 and b.accuracy == 0.0
    a, _ = evaluation_summary(frame, "phase", shift=1).orderBy("phase").collect()
    assert (a.target_tokens, a.correct_tokens) == (3, 1)


@pytest.mark.parametrize("shift", [0, 1])
def test_nothing_to_evaluate(spark, shift):
    (row,) = evaluation_summary(spark.createDataFrame([], SCHEMA), shift=shift).collect()
    assert math.isinf(row.avg_loss) and row.accuracy == 0.0 and row.batches == 0
