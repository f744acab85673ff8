"""Ranks and first-n against plain window functions and sorting."""

import hashlib

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from snipmill.functions.hashing import draw
from snipmill.operators.ranking import (
    first_by_draw,
    first_per_group,
    hash_bucket,
    position_bucket,
    with_rank,
)


@pytest.fixture
def skewed(spark):
    """Two thirds of all rows in one group, a group of one row, a null group."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, "hot")
        .when(F.col("id") == 2, "single")
        .when(F.col("id") % 5 == 0, F.lit(None))
        .otherwise("other")
        .alias("g"),
        F.col("id").cast("string").alias("k"),
        (F.col("id") * 40).alias("p"),
        draw("salt", F.col("id").cast("string")).alias("d"),
    )


def test_rank_equals_row_number(skewed):
    ranked = with_rank(skewed, ["g"], hash_bucket(F.col("d")), ["d", "k"])
    plain = F.row_number().over(Window.partitionBy("g").orderBy("d", "k"))
    wanted = skewed.withColumn("rank", plain)
    assert ranked.columns == wanted.columns
    assert ranked.count() == 3000
    assert ranked.exceptAll(wanted).isEmpty()


@pytest.mark.parametrize("n", [0, 1, 25, 100_000])
def test_first_per_group(skewed, n):
    found = first_per_group(skewed, ["g"], position_bucket(F.col("p")), ["p"], F.lit(n))
    plain = F.row_number().over(Window.partitionBy("g").orderBy("p"))
    wanted = skewed.withColumn("rank", plain).where(F.col("rank") <= n)
    assert found.count() == wanted.count()
    assert found.exceptAll(wanted).isEmpty()


@pytest.mark.parametrize("n", [0, 1, 2, 999, 3000, 5000])
def test_first_by_draw(skewed, n):
    found = {r.k for r in first_by_draw(skewed, "d", n, ["k"]).collect()}
    by_hash = sorted(
        (str(i) for i in range(3000)), key=lambda k: hashlib.md5(f"salt|{k}".encode()).digest()
    )
    assert found == set(by_hash[:n])


def test_ties_are_cut_exactly(spark):
    same = spark.range(500).select(F.lit("ffff0000").alias("d"), F.col("id").alias("k"))
    found = [r.k for r in first_by_draw(same, "d", 123, ["k"]).collect()]
    assert sorted(found) == list(range(123))


def test_positions_share_no_bucket_beyond_its_size(spark):
    buckets = spark.range(200_000).groupBy(position_bucket(F.col("id")).alias("b")).count()
    assert buckets.agg(F.max("count")).head()[0] == 1 << 16
