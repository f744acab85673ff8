"""Train/validation split, epoch batches and the step plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snipmill.functions.hashing import draw
from snipmill.operators.ranking import hash_bucket, with_rank
from snipmill.operators.sampling import row_key

# Fixed values of the training plan.
VALIDATION_RATIO = 0.15
SPLIT_SEED = "42"
BATCH_SIZE = 1
SWAPS = 40  # rounds of a shuffle


def share(rows: Column, ratio: float | Column) -> Column:
    """Whole rows in a share of ``rows``, in double arithmetic, rounded down."""
    factor = F.lit(float(ratio)) if isinstance(ratio, (int, float)) else ratio.cast("double")
    return F.floor(rows * factor).cast("bigint")


def validation_rows(rows: Column, ratio: float = VALIDATION_RATIO) -> Column:
    """Size of the validation part: a share, at least one, and never everything."""
    wanted = F.greatest(share(rows, ratio), F.lit(1))
    possible = (rows > 1) & F.lit(ratio > 0) & (wanted < rows)
    return F.when(possible, wanted).otherwise(0)


def split_train_validation(
    selection: DataFrame,
    keys: Sequence[str] = ("phase",),
    ratio: float = VALIDATION_RATIO,
    seed: str = SPLIT_SEED,
) -> DataFrame:
    """Add ``part`` (train or val), exact in size per group, the ``place`` in it, and ``of``,
    the rows of the part."""
    keyed = selection.withColumn("_key", row_key(selection))
    drawn = keyed.withColumn("_draw", draw(seed, F.col("_key")))
    ranked = with_rank(drawn, keys, hash_bucket(F.col("_draw")), ["_draw", "_key"], size="_rows")
    held_out = F.col("rank") <= F.col("_val")
    return (
        ranked.withColumn("_val", validation_rows(F.col("_rows"), ratio))
        .withColumn("part", F.when(held_out, "val").otherwise("train"))
        .withColumn(
            "place", F.when(held_out, F.col("rank")).otherwise(F.col("rank") - F.col("_val"))
        )
        .withColumn(
            "of", F.when(held_out, F.col("_val")).otherwise(F.col("_rows") - F.col("_val"))
        )
        .drop("_draw", "_key", "_rows", "_val", "rank")
    )


def shuffled_place(place: Column, of: Column, seed: Column) -> Column:
    """Where a place from 0 to ``of`` - 1 goes in an order that follows ``seed``.

    A swap-or-not shuffle (Hoang, Morris and Rogaway, 2012): each round pairs the places
    whose sum is a key, and a bit of a hash of the pair tells whether the two change
    places. Every round is its own inverse, so whatever the hashes, no two places ever
    go to the same one, and no row has to meet another.
    """

    def swapped(x: Column, turn: Column) -> Column:
        name = F.concat_ws("|", seed, turn)
        key = F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("bigint")
        other = (key % of - x + of) % of
        pair = F.concat_ws("|", name, F.greatest(x, other).cast("string"))
        return F.when(F.substring(F.md5(pair), 1, 1) >= "8", other).otherwise(x)

    turns = F.array(*(F.lit(str(i)) for i in range(SWAPS)))
    return F.aggregate(turns, place.cast("bigint"), swapped)


def epoch_batches(
    split: DataFrame,
    epochs: int | Column,
    batch_size: int = BATCH_SIZE,
    keys: Sequence[str] = ("phase",),
) -> DataFrame:
    """One row per epoch and snippet, with its 0-based ``batch``.

    Training rows come in a new random order each epoch, validation rows always
    in the order of the split. The last batch may be short. No epochs give no
    rows; a group whose number of epochs is not known fails the job.

    Orders follow from ``place`` and ``of`` of the split alone, row by row: nothing is
    counted, sorted or shuffled again, however many epochs there are. Only for a split
    without ``of`` the rows of its parts are counted, by ``keys``.
    """
    if "of" not in split.columns:
        sizes = split.groupBy(*keys, "part").agg(F.count("*").alias("of"))
        split = split.join(sizes, [*keys, "part"]).select(*split.columns, "of")
    count = F.lit(epochs) if isinstance(epochs, int) else epochs
    known = F.coalesce(count, F.raise_error(F.lit("a group has no number of epochs")))
    numbers = F.when(known >= 1, F.sequence(F.lit(1), known))
    per_epoch = split.withColumn("epoch", F.explode(numbers))
    seed = F.col("epoch").cast("string")
    drawn = shuffled_place(F.col("place") - 1, F.col("of").cast("bigint"), seed)
    place = F.when(F.col("part") == "train", drawn).otherwise(F.col("place") - 1)
    return per_epoch.withColumn("batch", F.floor(place / batch_size)).drop("of")


def step_plan(
    split: DataFrame,
    epochs: Column,
    warmup_ratio: float | Column,
    batch_size: int = BATCH_SIZE,
    keys: Sequence[str] = ("phase",),
) -> DataFrame:
    """Rows, steps per epoch, total steps and warm-up steps of each group.

    ``epochs`` and a column of warm-up ratios may use the keys.
    """
    per_epoch = F.ceil(F.col("train") / batch_size)
    return (
        split.groupBy(*keys)
        .agg(
            F.count("*").alias("selected"),
            F.count_if(F.col("part") == "train").alias("train"),
            F.count_if(F.col("part") == "val").alias("val"),
        )
        .withColumn("steps_per_epoch", per_epoch)
        .withColumn("total_steps", F.col("steps_per_epoch") * epochs)
        .withColumn("warmup_steps", share(F.col("total_steps"), warmup_ratio))
    )
