"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snipmill.session import materialise


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Tie neighbours of each node to the smallest node among them.

    ``edges`` has ``a`` > ``b``. The large star ties the larger neighbours of a
    node, the small star the node and its smaller neighbours.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        tied = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        below = edges.join(least, "a").where("b <> m")
        tied = below.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return tied.distinct()


def components(edges: DataFrame) -> DataFrame:
    """Per node of an edge: ``id`` and ``component``, the smallest node it can reach.

    ``edges`` has columns ``a`` and ``b``; loops, repeated and reversed edges and
    rows with a null do no harm. Large and small stars take turns (Kiveris et al.,
    2014) until nothing changes, after a number of rounds that grows with the
    logarithm of the graph. Each round is written to the shared folder; only a
    count and a checksum of it come to the driver. A hub's edges are combined
    before the shuffle, and joins on it can be split.
    """
    edges = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now = materialise(edges.distinct(), "edges")
    mark = None
    while True:
        before, now = mark, materialise(_stars(_stars(now, True), False), "stars")
        mark = tuple(
            now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        )
        if mark == before:
            break
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
