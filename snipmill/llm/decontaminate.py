"""Benchmark decontamination by spaced seeds, in DataFrame functions alone.

A spaced seed is a fixed mask over a few token positions that follow each other.
Only the positions marked 1 are hashed, so a substituted token under a 0 leaves the
hash as it is (Ma, Tromp and Li, 2002). Several masks are used, as a substitution
under a 1 of one mask often lies under a 0 of another.

1. Texts are cut into words. Each mask is hashed at each word, of the benchmark
   and of the documents, and the hashes are joined.
2. A hit lays item and document over each other. In the words around it, hits are
   verified by the stretch of ``window`` words of the item (or the whole item, if
   it is shorter) of which the most are equal in the document. The overlap counts
   if at least ``percent`` of the stretch are. Words are compared by 64-bit hashes.

The masks lose nothing: whichever words of a stretch are substituted, as long as
``percent`` are equal, one mask hits inside the stretch. Items shorter than the window
are stretches of their own length with masks of their own, down to a single word.
So the result is that of laying every item over every word of every document.

Documents pass through both steps in one stage, piece by piece with the words
around each piece, so no text is shuffled; only verified hits are, combined before.
Hits that follow each other in a piece, in the same laying, are verified once, in all
words around them. Where both sides repeat a single word, their seeds are joined only if
one of them begins its run, which each laying passes, so the rows are as many as layings.
Only pieces in which a mask sees a single word are looked through for such runs.

The benchmark is dealt into blocks of at most ``BLOCK_WORDS`` words, counted before they are
broadcast, and each block meets all documents, whatever the size of the benchmark. An
item that is longer by itself is joined without a broadcast.

Words are runs of anything but ASCII white space and common punctuation, A-Z in
lower case. Results, defined for every input: null and empty texts have no words
and no overlap. Where an item and a document share fewer words than the stretch,
nothing is found. Documents and items without id are left out.
Of repeated ids every text is searched, and what is found twice is returned once.
Further columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, eq, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snipmill.llm.common import lower_ascii
from snipmill.session import materialise

WORD = r"""[^\x20\x09-\x0D.,;:!?"'()\[\]]+"""
WINDOW, PERCENT = 13, 75
# By the words of a stretch and how many may be substituted: masks of which one hits in
# each such stretch. Found by greedy set cover; the tests enumerate all substitutions.
LOSSLESS = {
    (13, 3): ("111011", "1100001011", "10001110001"),
    (12, 3): ("111011", "110100011", "10010111", "111001001"),
    (11, 2): ("1101011", "11100000101"),
    (10, 2): ("111011", "11010011", "111001001"),
    (9, 2): ("11101", "10000111"),
    (8, 2): ("11011", "11000011", "1111"),
    (7, 1): ("11011",),
    (6, 1): ("11101", "10111"),
    (5, 1): ("111", "1101"),
    (4, 1): ("111", "1101", "1011"),
    (3, 0): ("111",),
    (2, 0): ("11",),
    (1, 0): ("1",),
}
MASKS = tuple(dict.fromkeys(mask for masks in LOSSLESS.values() for mask in masks))
PIECE = 64  # word positions of a document that are hashed in one row
BLOCK_WORDS = 400_000  # of items that are broadcast at once, with a seed per word and mask


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text; a null text has none."""
    found = F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))
    return F.transform(F.coalesce(found, F.array().cast("array<string>")), lambda w: F.xxhash64(w))


def masks_of(length: int, percent: int) -> tuple[str, ...]:
    """Masks of which one hits in every stretch of this length that passes."""
    equal = max(-(-percent * length // 100), 1)
    substituted = length - equal
    # Of the runs between substituted words, the longest has at least this length.
    run = "1" * -(-equal // (substituted + 1))
    return LOSSLESS.get((length, substituted), (run,))


def _marked(words: Column, at: Column, mask: str) -> list[Column]:
    return [F.get(words, at + i) for i, m in enumerate(mask) if m == "1"]


def _all(tests: list[Column]) -> Column:
    return F.coalesce(reduce(and_, tests), F.lit(False))


def _seed(k: int, words: Column, at: Column, mask: str) -> tuple[Column, Column, Column]:
    """Whether a mask fits at a position, its hash, and whether it goes on there with a
    run of a single word."""
    marked = _marked(words, at, mask)
    run = [word == marked[0] for word in marked[1:] + _marked(words, at - 1, mask)]
    return at + len(mask) <= F.size(words), F.xxhash64(F.lit(k), *marked), _all([at > 0, *run])


def _positions(n: Column) -> Column:
    """0 to n - 1, and nothing for 0."""
    return F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)))


def _item_seeds(items: DataFrame, masks: dict[str, list[int]], window: int) -> DataFrame:
    """Seeds of the items; those within a run of a single word have other hashes."""
    placed = items.select("item", "item_words", _positions(F.size("item_words")).alias("item_at"))
    seeds = []
    for k, (mask, lengths) in enumerate(masks.items()):
        fits, seed, within = _seed(k, F.col("item_words"), F.col("item_at"), mask)
        fits &= F.least(F.size("item_words"), F.lit(window)).isin(lengths)
        seed = F.when(within, F.bitwise_not(seed)).otherwise(seed).alias("seed")
        seeds.append(F.when(fits, F.struct(F.lit(k).alias("mask"), seed)))
    seeds = placed.select("item", "item_at", F.explode(F.array(*seeds)).alias("s"))
    return seeds.where("s IS NOT NULL").select("item", "item_at", "s.mask", "s.seed")


def _doc_seeds(docs: DataFrame, masks: dict[str, list[int]], window: int) -> DataFrame:
    """Seeds of the documents, each with the words around its piece. Where a run of a
    single word begins in the piece, also the hashes of items' seeds within such runs."""
    n = F.size("words")
    starts = F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(PIECE))))
    from_word = F.greatest(F.col("piece") - window, F.lit(0))
    reach = F.col("piece") - from_word + PIECE + max(map(len, masks)) + window
    pieces = docs.select("doc_id", "words", starts.alias("piece")).select(
        "doc_id",
        "piece",
        from_word.alias("from_word"),
        F.slice("words", from_word + 1, reach).alias("around"),
    )
    before = F.col("piece") - F.col("from_word")
    # Before the positions are exploded, so that it is done once per piece.
    pieces = pieces.withColumn("begun", _begun(masks, before))
    placed = pieces.select(
        "doc_id", "from_word", "around", "begun",
        _positions(F.least(F.size("around") - before, F.lit(PIECE))).alias("at"), before.alias("before"),
    )
    local = F.col("at") + F.col("before")
    seeds = []
    for k, mask in enumerate(masks):
        fits, seed, _ = _seed(k, F.col("around"), local, mask)
        seeds.append(F.when(fits, seed))
    more = F.coalesce(F.get("begun", F.col("at")), F.array().cast("array<bigint>"))
    found = placed.select(
        "doc_id", "from_word", "around", "at", local.alias("local"),
        F.explode(F.concat(F.array(*seeds), more)).alias("seed"),
    )
    return found.where("seed IS NOT NULL")


def _begun(masks: dict[str, list[int]], before: Column) -> Column:
    """Per position of a piece, the hashes of items' seeds within runs of a single word,
    where such a run begins; null for pieces in which no mask sees a single word."""
    around = F.col("around")

    def single(at: Column, mask: str) -> Column:
        marked = _marked(around, at, mask)
        return _all([at >= 0, *(word == marked[0] for word in marked[1:])])

    def sees_single(at: Column) -> Column:
        """Whether some mask sees one word, with its first two marks side by side here;
        two words that differ, as most do, settle it."""
        side_by_side = [single(at - mask.index("11"), mask) for mask in masks if "11" in mask]
        apart = [single(at, mask) for mask in masks if "11" not in mask]
        follows = F.get(around, at) == F.get(around, at + 1)
        return reduce(or_, [*apart, follows & reduce(or_, [*side_by_side, F.lit(False)])])

    def seeds(at: Column) -> Column:
        begun = []
        for k, mask in enumerate(masks):
            _, seed, within = _seed(k, around, at + before, mask)
            begins = single(at + before, mask) & ((at == 0) | ~within)
            begun.append(F.when(begins, F.bitwise_not(seed)))
        return F.array(*begun)

    own = F.sequence(F.lit(0), F.least(F.size(around) - before, F.lit(PIECE)) - 1)
    some = F.exists(F.sequence(F.lit(0), F.size(around) - 1), sees_single)
    return F.when(F.coalesce(some, F.lit(False)), F.transform(own, seeds))


def _hit(masks: dict[str, list[int]], window: int, step: int) -> list[Column]:
    """Per mask: whether it hits so many words after a hit."""
    at, item_at = F.col("local") + step, F.col("item_at") + step
    around, item = F.col("around"), F.col("item_words")
    return [
        _all(
            [
                item_at >= 0,
                item_at + len(mask) <= F.size(item),
                at + len(mask) <= F.size(around),
                F.least(F.size(item), F.lit(window)).isin(lengths),
                *map(eq, _marked(around, at, mask), _marked(item, item_at, mask)),
            ]
        )
        for mask, lengths in masks.items()
    ]


def _first(masks: dict[str, list[int]], window: int) -> Column:
    """Whether a hit is the first of those that follow each other in its piece and
    laying: none is at the word before, nor one of an earlier mask at the same word."""
    before = (F.col("at") > 0) & reduce(or_, _hit(masks, window, -1))
    earlier = [(F.col("mask") > k) & hit for k, hit in enumerate(_hit(masks, window, 0))]
    return ~before & ~reduce(or_, earlier)


def _near(masks: dict[str, list[int]], window: int) -> tuple[Column, Column, Column]:
    """The words of the item around a hit and those that follow it in the piece, and the
    words of a stretch."""
    diagonal = F.col("local") - F.col("item_at")
    end = F.least(F.size("item_words"), F.size("around") - diagonal)
    alone = F.least(F.col("item_at") + max(map(len, masks)) + window, end)
    return (
        F.greatest(F.col("item_at") - window, F.lit(0), -diagonal),
        F.when(reduce(or_, _hit(masks, window, 1)), end).otherwise(alone),
        F.least(F.lit(window), F.size("item_words")),
    )


def _most_equal() -> Column:
    """Most equal words of a stretch among those near a hit."""
    low, high, length = F.col("low"), F.col("high"), F.col("of_words")
    diagonal = F.col("local") - F.col("item_at")
    equal = F.transform(
        F.sequence(low, high - 1),
        lambda j: F.coalesce(
            F.get(F.col("around"), j + diagonal) == F.get(F.col("item_words"), j), F.lit(False)
        ).cast("int"),
    )
    sums = F.transform(
        F.sequence(F.lit(0), high - low - length),
        lambda s: F.aggregate(F.slice(equal, s + 1, length), F.lit(0), lambda a, x: a + x),
    )
    return F.when(high - low >= length, F.array_max(sums))


def _blocks(
    items: DataFrame, masks: dict[str, list[int]], window: int, words: int
) -> list[tuple[DataFrame, DataFrame]]:
    """Items and their seeds, block by block. The driver gets a number per block."""
    n = 1 if words <= BLOCK_WORDS else -(-2 * words // BLOCK_WORDS)
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(n)))
    dealt = materialise(dealt, "benchmark-blocks")
    seeds = materialise(
        _item_seeds(dealt, masks, window).withColumn("block", F.pmod(F.xxhash64("item"), F.lit(n))),
        "benchmark-seeds",
    )
    sizes = dealt.groupBy("block").agg(F.sum(F.size("item_words")).alias("words")).collect()
    found = []
    for block, size in sizes or [(0, 0)]:
        own = [df.where(F.col("block") == block).drop("block") for df in (dealt, seeds)]
        found.append(tuple(map(F.broadcast, own)) if size <= BLOCK_WORDS else tuple(own))
    return found


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    percent: int = PERCENT,
) -> DataFrame:
    """Per document and item that overlap: ``doc_id``, ``item_id``, the most equal words
    of a stretch, the words of the stretch, and the number of different layings."""
    items = benchmark.where(F.col(item_col).isNotNull()).select(
        F.struct(F.col(item_col).alias("id"), F.xxhash64(item_text_col).alias("text")).alias("item"),
        word_hashes(F.col(item_text_col)).alias("item_words"),
    )
    items = items.where(F.size("item_words") > 0).distinct()
    items = materialise(items, "benchmark-items")
    size = F.size("item_words")
    counted = items.agg(
        F.collect_set(F.least(size, F.lit(window))).alias("lengths"), F.sum(size).alias("words")
    ).first()
    # Masks of all lengths that occur, each with its lengths.
    masks: dict[str, list[int]] = {}
    for length in sorted(counted["lengths"] or [window]):
        for mask in masks_of(length, percent):
            masks.setdefault(mask, []).append(length)
    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), word_hashes(F.col(text_col)).alias("words")
    )
    doc_seeds = _doc_seeds(rows, masks, window)
    hits = reduce(
        DataFrame.unionByName,
        (
            doc_seeds.join(seeds, "seed").join(own, "item")
            for own, seeds in _blocks(items, masks, window, counted["words"] or 0)
        ),
    )
    low, high, length = _near(masks, window)
    near = hits.where(_first(masks, window)).select(
        "doc_id", "item", "from_word", "local", "item_at", "around", "item_words",
        low.alias("low"), high.alias("high"), length.alias("of_words"),
    )
    laid = near.select(
        "doc_id",
        F.col("item.id").alias("item_id"),
        (F.col("from_word") + F.col("local") - F.col("item_at")).alias("item_begin"),
        _most_equal().alias("equal_words"),
        "of_words",
    ).where(100 * F.col("equal_words") >= percent * F.col("of_words"))
    best = F.max(F.struct("equal_words", "of_words"))
    return (
        laid.groupBy("doc_id", "item_id", "item_begin")
        .agg(best.alias("best"))
        .groupBy("doc_id", "item_id")
        .agg(F.max("best").alias("best"), F.count("*").alias("layings"))
        .select("doc_id", "item_id", "best.equal_words", "best.of_words", "layings")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without an overlap, with all their columns. Every text is judged by
    itself, whether its id is missing or another text has it too."""
    keyed = docs.withColumn("_key", F.struct("doc_id", F.xxhash64("text").alias("text")))
    found = overlaps(keyed, benchmark, id_col="_key").select(F.col("doc_id").alias("_key"))
    return keyed.join(found.distinct().hint("merge"), "_key", "left_anti").select(*docs.columns)
