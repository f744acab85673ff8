"""Exact first-n and rank operators that never gather a group in one task.

A plain ``row_number`` over a group puts the whole group into one task. Here a
group is cut into buckets that follow the sort order. A count per bucket, which
combines before its shuffle, tells where each bucket starts, and rows are
numbered only inside their bucket.

Buckets must be small by construction. Two kinds are: the leading hex digits of
a hash (:func:`hash_bucket`), which split any group evenly, and runs of
positions that are unique in their group (:func:`position_bucket`).

A bucket is identified by one struct of keys and place. Structs compare equal
where both hold a null, so a null key makes a group like any other, and the
window and the join that follow share one shuffle on that struct.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snipmill.session import materialise

POSITION_BITS = 16

_BUCKET, _PLACE, _COUNT = "_bucket", "_place", "_in_bucket"
_BELOW, _TOTAL, _WITHIN = "_below", "_total", "_within"


def hash_bucket(draw: Column) -> Column:
    """One of 65,536 even slices of a uniform hex value."""
    return F.substring(draw, 1, 4)


def position_bucket(position: Column) -> Column:
    """Run of consecutive positions; holds at most 65,536 rows of a group."""
    return F.shiftright(position.cast("bigint"), POSITION_BITS)


def _bucketed(df: DataFrame, keys: Sequence[str], place: Column) -> DataFrame:
    return df.withColumn(_BUCKET, F.struct(*keys, place.alias(_PLACE)))


def _offsets(bucketed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per bucket: its rows, the rows of its group before it, and in all."""
    group = Window.partitionBy(*(F.col(_BUCKET)[k] for k in keys))
    before = group.orderBy(F.col(_BUCKET)[_PLACE]).rowsBetween(Window.unboundedPreceding, -1)
    counts = bucketed.groupBy(_BUCKET).agg(F.count("*").alias(_COUNT))
    return counts.select(
        _BUCKET,
        _COUNT,
        F.coalesce(F.sum(_COUNT).over(before), F.lit(0)).alias(_BELOW),
        F.sum(_COUNT).over(group).alias(_TOTAL),
    )


def _within(order: Sequence[str]) -> Column:
    return F.row_number().over(Window.partitionBy(_BUCKET).orderBy(*order))


def with_rank(
    df: DataFrame,
    keys: Sequence[str],
    place: Column,
    order: Sequence[str],
    size: str | None = None,
) -> DataFrame:
    """Add ``rank``, the 1-based position of a row in its group, to every row,
    and the size of the group under the name ``size``.

    Rows are read twice, to count and to number them. If the second time a row
    falls into a bucket that was not counted, the job fails; no row is lost.
    """
    bucketed = _bucketed(df, keys, place)
    numbered = bucketed.withColumn(_WITHIN, _within(order))
    ranked = numbered.join(_offsets(bucketed, keys), _BUCKET, "left")
    below = F.coalesce(F.col(_BELOW), F.raise_error(F.lit("input changed while it was ranked")))
    return ranked.select(
        *df.columns,
        (below + F.col(_WITHIN)).alias("rank"),
        *([F.col(_TOTAL).alias(size)] if size else []),
    )


def first_per_group(
    df: DataFrame, keys: Sequence[str], place: Column, order: Sequence[str], n: Column
) -> DataFrame:
    """The first ``n`` rows of each group, with their ``rank``.

    Buckets that lie wholly behind the n-th row are dropped by a join with the
    list of the others before anything wide is shuffled. That list is written
    first, so its true size decides whether Spark broadcasts it.
    """
    bucketed = _bucketed(df, keys, place)
    reached = materialise(
        _offsets(bucketed, keys).where(F.col(_BELOW) < n), "reached-buckets"
    )
    ranked = bucketed.join(reached, _BUCKET).withColumn(
        "rank", F.col(_BELOW) + _within(order)
    )
    return ranked.where(F.col("rank") <= n).select(*df.columns, "rank")


def reaching_buckets(df: DataFrame, keys: Sequence[str], draw: str, n: Column) -> DataFrame:
    """Per group, the last hash bucket one has to read to find ``n`` rows."""
    offsets = _offsets(_bucketed(df, keys, hash_bucket(F.col(draw))), keys)
    fields = [F.col(_BUCKET)[k].alias(k) for k in keys]
    return (
        offsets.select(*fields, F.col(_BUCKET)[_PLACE].alias(_PLACE), _BELOW)
        .where(F.col(_BELOW) < n)
        .groupBy(*keys)
        .agg(F.max(_PLACE).alias("last_bucket"))
    )


def first_by_draw(df: DataFrame, draw: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows with the smallest ``draw``: a sample without replacement.

    One scan counts the rows per slice of the draw and finds the slice that
    holds the n-th row; a single row comes to the driver. A second scan keeps
    what lies before it, and numbers only the rows inside their slice.
    """
    bucketed = _bucketed(df, [], hash_bucket(F.col(draw)))
    place = F.col(_BUCKET)[_PLACE]
    reached = _offsets(bucketed, []).select(place.alias(_PLACE), (n - F.col(_BELOW)).alias("open"))
    last = reached.where("open > 0").agg(F.max(F.struct(_PLACE, "open")).alias("last")).head().last
    if last is None:
        return df.limit(0)
    return (
        bucketed.where(place <= last[_PLACE])
        .withColumn(_WITHIN, _within([draw, *ties]))
        .where((place < last[_PLACE]) | (F.col(_WITHIN) <= last["open"]))
        .select(*df.columns)
    )
