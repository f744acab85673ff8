"""Exact samples without replacement, replay shares and used ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snipmill.functions.hashing import draw
from snipmill.operators.ranking import first_by_draw, hash_bucket, with_rank

# Language whose snippets are replayed in phases of other languages.
REPLAY_LANGUAGE = "python"


def of_language(pool: DataFrame, language: str | None) -> DataFrame:
    """Rows of one language, spelled exactly so; all rows when it is not set."""
    return pool.where(F.col("language") == language) if language else pool


def exclude_used(pool: DataFrame, used: DataFrame) -> DataFrame:
    """Pool rows whose id was not used. Rows without an id always stay.

    Spark picks the join by the size of the used ids, which it knows of a written table.
    """
    ids = used.select("snippet_id").where("snippet_id IS NOT NULL")
    return pool.join(ids, "snippet_id", "left_anti")


def used_ids(*selections: DataFrame) -> DataFrame:
    """Distinct ids of the selections; missing and empty ids are not recorded."""
    ids = selections[0].select("snippet_id")
    for more in selections[1:]:
        ids = ids.unionByName(more.select("snippet_id"))
    return ids.where("snippet_id IS NOT NULL AND snippet_id <> ''").distinct()


def row_key(pool: DataFrame) -> Column:
    """What a row is drawn by: its id, or where it came from if it has none.

    A selection has this key as a column, as it does not know where rows came from.
    """
    if "row_key" in pool.columns:
        return F.col("row_key")
    origin = [c for c in ("source_config_id", "original_id") if c in pool.columns]
    return F.coalesce(F.col("snippet_id"), F.concat_ws("/", *origin) if origin else F.lit(""))


def sample(pool: DataFrame, n: int, salt: str, language: str | None = None) -> DataFrame:
    """Exactly ``min(n, rows)`` rows of a language, or of all languages."""
    keyed = of_language(pool, language).withColumn("_key", row_key(pool))
    candidates = keyed.withColumn("_draw", draw(salt, F.col("_key")))
    return first_by_draw(candidates, "_draw", n, ties=["_key"]).drop("_draw", "_key")


def replay_quota(
    main_rows: int,
    language: str | None,
    ratio: float = 0.0,
    rows: int = 0,
    replay_language: str = REPLAY_LANGUAGE,
) -> int:
    """How many replay rows go with a main selection: a share of it, else a number."""
    if language == replay_language:
        return 0
    return int(main_rows * ratio) if ratio > 0 else max(rows, 0)


def replay_sample(
    pool: DataFrame,
    used: DataFrame,
    n: int,
    salt: str,
    replay_language: str = REPLAY_LANGUAGE,
) -> DataFrame:
    """``n`` rows of the replay language out of those not used yet; ``used`` holds
    the ids of earlier phases and of this phase's main selection."""
    candidates = exclude_used(of_language(pool, replay_language), used)
    return sample(candidates, n, salt)


def shuffled(selection: DataFrame, salt: str, *keys: str) -> DataFrame:
    """Add ``position``, the 1-based place in a random order of each group."""
    keyed = selection.withColumn("_key", row_key(selection))
    drawn = keyed.withColumn("_draw", draw(salt, F.col("_key")))
    ranked = with_rank(drawn, keys, hash_bucket(F.col("_draw")), ["_draw", "_key"])
    return ranked.withColumnRenamed("rank", "position").drop("_draw", "_key")
