"""Loss and accuracy over a table of predictions, one row per batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluation_summary(
    predictions: DataFrame, *keys: str, shift: int = 0
) -> DataFrame:
    """Mean batch loss and token accuracy, per group of ``keys`` or over all.

    A prediction counts against the label ``shift`` places later, where that
    label has attention 1. Tokens are counted inside their row; exploding them
    would multiply the table. A batch without a loss adds nothing to the sum
    but counts as a batch. No batches: infinite loss; no tokens: accuracy 0.
    """

    def at(name: str, place: Column) -> Column:
        return F.get(name, place + shift)

    target = F.filter("attention", lambda a, place: (a == 1) & (place >= shift))
    correct = F.filter(
        "pred", lambda p, place: (at("label", place) == p) & (at("attention", place) == 1)
    )
    counted = predictions.select(
        *keys, "loss", F.size(target).alias("_target"), F.size(correct).alias("_correct")
    )
    totals = counted.groupBy(*keys).agg(
        F.count("*").alias("batches"),
        F.coalesce(F.sum("loss"), F.lit(0.0)).alias("_loss"),
        F.coalesce(F.sum("_target"), F.lit(0)).alias("target_tokens"),
        F.coalesce(F.sum("_correct"), F.lit(0)).alias("correct_tokens"),
    )
    return totals.select(
        *keys,
        "batches",
        "target_tokens",
        "correct_tokens",
        F.when(F.col("batches") > 0, F.col("_loss") / F.col("batches"))
        .otherwise(float("inf"))
        .alias("avg_loss"),
        F.when(F.col("target_tokens") > 0, F.col("correct_tokens") / F.col("target_tokens"))
        .otherwise(0.0)
        .alias("accuracy"),
    )
