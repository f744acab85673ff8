"""Runs of words that repeat with a period, found tile by tile at every scale.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are
identical), at least ``LEAST`` words and ``TIMES`` periods long, that no neighbouring
word extends keeping the period. All runs of all texts are found, whatever their period.

1. Periods are cut into octaves: from ``B`` to ``2 B - 1`` words, ``B`` a power of two. For
   each octave a document is cut into tiles of ``OWN`` blocks of ``B`` words, which
   overlap by what a block needs on both sides. A run of such a period covers two whole
   blocks after each other, each of which recurs one period further on. Names of all
   stretches of ``B`` words come from names of ``B / 2`` words (a rolling doubling), so one
   comparison per word and octave tells which blocks may lie in a run. Tiles without
   any are left out; equal words have equal names, so nothing is lost.
2. A tile becomes a row with its own words and is solved by itself. At the boundary in
   front of each of its blocks, the Z-function of what follows tells how far words go on
   as they are one period further, and that of the reversed words before, how far back.
   A fragment is where both lead. Periods whose first words are themselves a repetition
   are left to the octave of the shorter period.
3. Fragments are shuffled by document and period. Those that overlap or touch are
   stitched; what is long enough is a run.

The work per octave is in proportion to the words, so a text costs its length times
the logarithm of it. A row holds one tile, a group the fragments of one document and
period; documents without tiles are never shuffled, of the others their text is once.

Words are ``[^\\x20\\x09-\\x0D]+``. Results, defined for every input: null, empty and blank
texts have no words and no runs. Every row is judged alone, so rows with equal or
missing ids keep their own results. Runs of different periods may overlap; ties are told
apart by start, then period. An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField, StructType

from snipmill.llm.common import Numbering, mixed, texts_of
from snipmill.session import materialise

LEAST, TIMES = 6, 4
OWN = 8  # blocks of a tile
BLANKS = r"[\x20\x09-\x0D]+"

TILES = ArrayType(StructType([
    StructField("octave", IntegerType()), StructField("start", IntegerType()),
    StructField("bounds", BinaryType()), StructField("words", BinaryType()),
]))
FRAGMENTS = ArrayType(StructType([
    StructField("period", IntegerType()), StructField("start", IntegerType()),
    StructField("stop", IntegerType()),
]))
_TILE, _FRAGMENT = (to_arrow_type(t) for t in (TILES, FRAGMENTS))
RUNS = "array<struct<start:bigint,period:bigint,length:bigint>>"


def tiles_of(words: np.ndarray) -> list[dict]:
    """Tiles of a document, given as numbers of its words, that may hold part of a run."""
    n, block, octave, tiles = len(words), 1, 0, []
    names = mixed(words.astype(np.uint64) + np.uint64(1))
    while TIMES * block <= n and n >= LEAST:
        blocks = n // block
        ahead = np.zeros(blocks * block, np.uint64)
        known = names[block : block + blocks * block]
        ahead[: len(known)] = known
        recurs = ahead.reshape(blocks, block) == names[: blocks * block : block, None]
        pairs = np.flatnonzero((recurs[:-1] & recurs[1:]).any(axis=1))
        if len(pairs):
            marked = np.unique(np.concatenate([pairs, pairs + 1]))
            for tile in np.unique(marked // OWN).tolist():
                first = tile * OWN
                start = max(0, (first - 1) * block)
                bounds = marked[(marked >= first) & (marked < first + OWN)] * block - start
                own = words[start : (first + OWN + 3) * block]
                tiles.append({
                    "octave": octave, "start": start,
                    "bounds": bounds.astype("<i4").tobytes(), "words": own.astype("<i4").tobytes(),
                })
        names = mixed(names[:-block] * np.uint64(3) + names[block:]) if len(names) > block else names[:0]
        block, octave = 2 * block, octave + 1
    return tiles


def z_function(words: list[int], stop: int) -> list[int]:
    """Per place before ``stop``: how many words from there equal those from the start."""
    n = len(words)
    z, left, right = [0] * stop, 0, 0
    for i in range(1, stop):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and words[k] == words[i + k]:
            k += 1
        z[i] = k
        left, right = i, i + k
    return z


@lru_cache(1 << 14)
def _divisors(q: int) -> tuple[int, ...]:
    small = [d for d in range(1, int(q**0.5) + 1) if q % d == 0]
    return tuple(sorted({*small, *(q // d for d in small)} - {q}))


def solved(words: list[int], octave: int, start: int, bounds: list[int]) -> list[tuple[int, int, int]]:
    """Fragments of a tile: a period, and from where to where words equal those one period
    further on. Fragments of a period that meet inside the tile are one."""
    block = 1 << octave
    found: dict[int, list[list[int]]] = {}
    for c in bounds:
        after = z_function(words[c : c + 4 * block], min(2 * block, len(words) - c))
        low, high = max(0, c - block), min(c + 2 * block - 1, len(words))
        before = words[low:c][::-1]
        # -1 is the number of no word.
        text = [*before, -1, *words[low:high][::-1]]
        back = z_function(text, min(len(text), c - low + 2 + high - c))
        for q in range(block, len(after)):
            reach = after[q]
            if reach < block or any(after[d] >= q - d for d in _divisors(q)):
                continue
            a, b = c - back[c - low + 1 + high - c - q], c + reach
            own = found.setdefault(q, [])
            if own and a <= own[-1][1]:
                own[-1] = [min(a, own[-1][0]), max(b, own[-1][1])]
            else:
                own.append([a, b])
    return [(q, start + a, start + b) for q, own in found.items() for a, b in own]


@F.arrow_udf(TILES)
def tiles(texts: pa.Array) -> pa.Array:
    """Tiles of each text."""
    out = []
    for text in texts_of(texts):
        numbers = Numbering()
        words = text.split()
        out.append(tiles_of(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))))
    return pa.array(out, _TILE)


@F.arrow_udf(FRAGMENTS)
def fragments(octaves: pa.Array, starts: pa.Array, bounds: pa.Array, words: pa.Array) -> pa.Array:
    """Fragments of each tile."""
    numbers = lambda b: np.frombuffer(b, "<i4").tolist()
    columns = (octaves.to_pylist(), starts.to_pylist(), bounds.to_pylist(), words.to_pylist())
    out = []
    for octave, start, own, text in zip(*columns):
        keys = ("period", "start", "stop")
        out.append([dict(zip(keys, f)) for f in solved(numbers(text), octave, start, numbers(own))])
    return pa.array(out, _FRAGMENT)


@F.arrow_udf(StringType())
def without_repeats(texts: pa.Array, runs: pa.Array) -> pa.Array:
    """Words that no run contains behind its first period, joined by single spaces."""
    out = []
    for text, own in zip(texts_of(texts), runs.to_pylist()):
        words = text.split()
        edges = np.zeros(len(words) + 1, np.int64)
        for run in own or ():
            edges[run["start"] + run["period"]] += 1
            edges[run["start"] + run["length"]] -= 1
        covered = np.cumsum(edges)
        out.append(b" ".join(w for w, c in zip(words, covered) if not c))
    return pa.array(out, pa.binary()).cast(pa.string())


def plain(text: Column) -> Column:
    """The words of a text joined by single spaces; empty for a null text."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " "))


def stitched(parts: DataFrame) -> DataFrame:
    """Runs of rows, from the fragments ``row``, ``period``, ``start``, ``stop``."""
    order = Window.partitionBy("row", "period").orderBy("start", "stop")
    reached = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("start") > reached).cast("int"), F.lit(0))
    islands = parts.withColumn("opens", opens).withColumn("island", F.sum("opens").over(order))
    length = (F.max("stop") - F.min("start")).cast("bigint") + F.col("period")
    return (
        islands.groupBy("row", "period", "island")
        .agg(F.min("start").alias("start"), length.alias("length"))
        .where(F.col("length") >= F.greatest(F.lit(LEAST), TIMES * F.col("period")))
        .select("row", "start", "period", "length")
    )


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    finish: Callable[[Column], Column] = lambda text: text,
) -> DataFrame:
    """Per row: ``doc_id``, its ``runs`` (start, period and length in words, in this order),
    and ``collapsed``, its text without what runs repeat, passed through ``finish``, such
    as a digest, before it is kept."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cut = texts.withColumn("tiles", tiles("text"))
    some = F.size("tiles") > 0
    # Rows get their number here; what follows reads the written table.
    stored = materialise(
        cut.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.when(some, F.col("text")).alias("text"),
            F.when(~some, finish(plain(F.col("text")))).alias("collapsed"),
            "tiles",
        ),
        "periodic-tiles",
    )
    rows = stored.where(some).select("row", F.explode("tiles").alias("tile"))
    found = fragments("tile.octave", "tile.start", "tile.bounds", "tile.words")
    parts = rows.select("row", F.explode(found).alias("f")).select("row", "f.*")
    runs = (
        stitched(parts)
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct(
            F.col("start").cast("bigint").alias("start"),
            F.col("period").cast("bigint").alias("period"), "length",
        ))).alias("runs"))
    )
    joined = stored.where(some).select("row", "doc_id", "text").join(runs.hint("merge"), "row", "left")
    none = F.array().cast(RUNS)
    judged = joined.select(
        "doc_id",
        F.coalesce("runs", none).alias("runs"),
        finish(without_repeats("text", F.coalesce("runs", none))).alias("collapsed"),
    )
    return stored.where(~some).select("doc_id", none.alias("runs"), "collapsed").unionByName(judged)


def with_period(text: Column, h: Column) -> Column:
    """A text that repeats itself from some word on where 10 divides ``h``; others stay."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, g = F.size(words), F.floor(h / 10).cast("bigint")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    copies = F.ceil((n - a) / p).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), copies))
    made = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    return F.when((h % 10 == 0) & (n > 0), made).otherwise(text)


def summary(found: DataFrame) -> DataFrame:
    """Runs of each row in figures: how many, the one with the most periods, and digests.
    ``collapsed`` holds digests already."""
    more = lambda best, r: F.when(
        r["length"] * best["period"] > best["length"] * r["period"], r
    ).otherwise(best)
    best = F.aggregate("runs", F.get("runs", F.lit(0)), more)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
    )
