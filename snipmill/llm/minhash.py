"""Near-duplicates by b-bit MinHash, confirmed on full shingle sets.

1. A document is its set of distinct 5-word shingles. Documents with equal sets
   form a class, which goes on as one node, its smallest id.
2. Of 160 minima, every four in a row make a band key: two sets of similarity
   0.75 miss all 40 bands with a chance of 3e-7. The lowest two bits of all
   minima are packed into five longs. Only keys and packed bits are kept.
3. Each node is compared with the smallest of the ids that lead its bands:
   agreeing groups of two bits are counted by XOR and bit counts, the share is
   corrected for chance agreement (one in four), and pairs six standard deviations
   below the wanted similarity go. The others are confirmed on full sets, and
   give components.
4. Bands that hold several components stay open. In a few rounds, every node of an
   open band is compared with one node of another component that leads a band of it in
   this round, the one that its packed bits agree with most. In a group of copies, each round links a good part of what is left,
   at the cost of one comparison per node. A round that links few nodes is the last.
5. What is still apart is compared pair by pair, but only across components: nodes
   of open bands get 2048 further minima of one bit, and only pairs within five
   standard deviations of the wanted similarity leave the join, to be confirmed. They
   also get 1024 bits of parity, which differ in at most as many places as the sets:
   this never loses a link, and of sets of some hundred shingles it leaves few but the
   links. So no link between components is lost, and neither a group of copies nor
   groups that are almost alike make all their pairs. Bands have no cap; large ones
   are dealt over blocks, so that no task meets one whole.

Joins that move texts or sets are always sort-merge joins, which split hot keys and
make the same plan at every size. Sets are compared by the first 48 bits of their
shingles' hashes.

Ids are whole numbers. Results, defined for every input: a null text is an empty
text; a text without words has an empty set and is linked with nothing. Rows
without id are linked with nothing and kept; their component is null. Rows that
share an id are one node, linked if one of them is. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snipmill.llm.common import Numbering, hashes, mixed, texts_of
from snipmill.llm.graph import components
from snipmill.session import materialise

SHINGLE = 5  # words
BANDS, ROWS, BITS = 40, 4, 2
MINIMA = BANDS * ROWS
LONGS = -(-MINIMA * BITS // 64)
BLOCK = 512  # members of a band that meet in one block
CLOSER = 2048  # further minima, of which one bit is kept
PARITY = 1024  # bits that tell of how many shingles of their own they have an odd number
TRIES = 6  # rounds of step 4 at most
GAIN = 0.02  # share of the open nodes that a round must link for another one

_RANDOM = np.random.default_rng(20240229)
_MULTIPLY = _RANDOM.integers(0, 1 << 32, MINIMA, np.uint32) | np.uint32(1)
_FLIP = _RANDOM.integers(0, 1 << 32, MINIMA, np.uint32)
_PLACE = _RANDOM.integers(0, 1 << 63, max(SHINGLE, ROWS), np.uint64) | np.uint64(1)

FEATURES = "doc_id bigint, n_shingles bigint, set_key struct<a: bigint, b: bigint>"
BANDED = f"{FEATURES}, bands array<bigint>, bits array<bigint>"
SIZE_AT = (CLOSER + PARITY) // 64  # place of the number of shingles in a sketch
PART = 32_768  # shingles whose minima are taken together, to stay in the processor's cache


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a short text is one shingle."""
    numbers = Numbering()
    rows = []
    for text in texts:
        words = text.lower().split()
        rows.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
    known = hashes(numbers)
    for row in rows:
        n, own = len(row), known[row]
        if n >= size:
            parts = (own[k : n - size + 1 + k] * _PLACE[k] for k in range(size))
            yield np.unique(mixed(reduce(add, parts)))
        elif n:
            yield mixed((own * _PLACE[:n]).sum(keepdims=True) + np.uint64(n))
        else:
            yield own


_CLOSER_MULTIPLY = _RANDOM.integers(0, 1 << 32, CLOSER, np.uint32) | np.uint32(1)
_CLOSER_FLIP = _RANDOM.integers(0, 1 << 32, CLOSER, np.uint32)


def sketch(hashes48: np.ndarray) -> np.ndarray:
    """The lowest bits of further minima of a set, as longs."""
    values = (hashes48 >> np.uint64(16)).astype(np.uint32)
    least = np.full(CLOSER, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(values), 256):
        part = (values[at : at + 256, None] ^ _CLOSER_FLIP) * _CLOSER_MULTIPLY
        np.minimum(least, part.min(axis=0), out=least)
    # The lowest bit of a product with an odd factor is that of the value; take a middle one.
    bits = (least >> np.uint32(7) & np.uint32(1)).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def parity(hashes48: np.ndarray) -> np.ndarray:
    """Each shingle falls on a bit by its hash; set are those with an odd number, as longs.
    Two sets differ in at least as many shingles as their bits differ."""
    odd = np.bincount((hashes48 % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """One row of minima per non-empty set."""
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((MINIMA, len(sets)), np.uint32)
    buffer = np.empty_like(values)
    for k in range(MINIMA):
        np.bitwise_xor(values, _FLIP[k], out=buffer)
        np.multiply(buffer, _MULTIPLY[k], out=buffer)
        np.minimum.reduceat(buffer, starts, out=out[k])
    return out.T


def band_keys(found: np.ndarray) -> np.ndarray:
    rows = found.reshape(len(found), BANDS, ROWS).astype(np.uint64)
    keys = (rows * _PLACE[:ROWS]).sum(axis=2, dtype=np.uint64)
    keys += np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(keys).view(np.int64)


def packed_bits(found: np.ndarray) -> np.ndarray:
    """The lowest bits of all minima; unused groups of the last long are zero."""
    groups = 64 // BITS
    low = np.zeros((len(found), LONGS * groups), np.uint64)
    low[:, :MINIMA] = found & np.uint32((1 << BITS) - 1)
    shifts = np.arange(groups, dtype=np.uint64) * np.uint64(BITS)
    return (low.reshape(-1, LONGS, groups) << shifts).sum(axis=2, dtype=np.uint64).view(np.int64)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(r) for r in rows])
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    none = np.empty(0, np.int64)
    for batch in batches:
        ids, texts = batch.column(0), texts_of(batch.column(1))
        at = 0
        while at < len(texts):
            stop, total = at, 0
            while stop < len(texts) and total < 1 << 22:
                total += len(texts[stop])
                stop += 1
            sets = list(shingle_sets(texts[at:stop]))
            full = [i for i, s in enumerate(sets) if len(s)]
            bands, bits = [none] * len(sets), [none] * len(sets)
            first = 0
            while first < len(full):
                last, total = first, 0
                while last < len(full) and total < PART:
                    total += len(sets[full[last]])
                    last += 1
                found = minima([sets[i] for i in full[first:last]])
                for i, b, s in zip(full[first:last], band_keys(found), packed_bits(found)):
                    bands[i], bits[i] = b, s
                first = last
            keys = np.array(
                [np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64) for s in sets]
            )
            empty = pa.array([not len(s) for s in sets])
            key = pa.StructArray.from_arrays(
                [pa.array(keys[:, 0]), pa.array(keys[:, 1])], names=["a", "b"], mask=empty
            )
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(at, stop - at),
                    pa.array([len(s) for s in sets], pa.int64()),
                    key,
                    _lists(bands),
                    _lists(bits),
                ],
                names=["doc_id", "n_shingles", "set_key", "bands", "bits"],
            )
            at = stop


def packed_set(hashes: np.ndarray) -> bytes:
    """The first 48 bits of sorted hashes, as gaps in byte planes."""
    gaps = np.diff(hashes >> np.uint64(16), prepend=np.uint64(0))
    planes = np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8)[:, :6].T)
    return zstandard.compress(planes.tobytes(), 1)


def unpacked_set(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(6, -1)
    gaps = np.zeros((planes.shape[1], 8), np.uint8)
    gaps[:, :6] = planes.T
    return np.cumsum(gaps.view(np.uint64).ravel())


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed set of each text; of equal rows that follow each other only one."""
    last = None
    for batch in batches:
        for at in range(0, len(batch), 1000):
            part = batch.slice(at, 1000)
            ids, texts, rows = [], [], []
            for i, text in zip(part.column(0).to_pylist(), texts_of(part.column(1))):
                if (i, text) != last:
                    ids.append(i)
                    texts.append(text)
                last = (i, text)
            rows = [(i, packed_set(s)) for i, s in zip(ids, shingle_sets(texts)) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.binary()),
                ],
                names=["doc_id", "set"],
            )


def _similar(percent: int):
    """Pairs whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, keep = (None, None), []
            *rest, a, b = batch.schema.names
            for set_a, set_b in zip(batch.column(a).to_pylist(), batch.column(b).to_pylist()):
                if known[0] != set_a:
                    known = (set_a, unpacked_set(set_a))
                x, y = known[1], unpacked_set(set_b)
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                shared = int((x[at] == y).sum())
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(rest).filter(pa.array(keep, pa.bool_()))

    return run


def agreeing(a: Column, b: Column) -> Column:
    """Groups of bits in which two packed signatures agree."""
    low = F.lit(sum(1 << i for i in range(0, 64, BITS)))
    wrong = []
    for i in range(LONGS):
        x = a[i].bitwiseXOR(b[i])
        wrong.append(F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(low)))
    return F.lit(MINIMA) - reduce(add, wrong)


def sketch_columns(sketch: Column, prefix: str) -> list[Column]:
    """The longs of a sketch as columns without nulls: minima, parity, size. With longs taken
    out of lists inside a join, Java finds the code of the join too long to compile and
    interprets it."""
    return [
        F.coalesce(F.get(sketch, F.lit(i)), F.lit(0)).alias(f"{prefix}{i}")
        for i in range(SIZE_AT + 1)
    ]


def _differing(a: str, b: str, longs: range) -> Column:
    return reduce(add, (F.bit_count(F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))) for i in longs))


def agreeing_closer(a: str, b: str) -> Column:
    """Bits of minima in which two sketches agree, given by the prefixes of their columns."""
    return F.lit(CLOSER) - _differing(a, b, range(CLOSER // 64))


def possible(a: str, b: str, threshold: float) -> Column:
    """Whether two sets can be so similar, by their parity and sizes: never wrong about a pair
    that is. Of ``n`` shingles in both, it may differ in the share (1 - t) / (1 + t)."""
    x, y = F.col(f"{a}{SIZE_AT}"), F.col(f"{b}{SIZE_AT}")
    most = (x + y) * F.lit((1 - threshold) / (1 + threshold)) + F.lit(1e-6)
    differ = _differing(a, b, range(CLOSER // 64, SIZE_AT))
    return (F.abs(x - y) <= most) & (differ <= most)


def least_agreeing(threshold: float, n: int, bits: int, deviations: float) -> int:
    """How many of ``n`` values agree at least, where equal minima and chance leave some
    standard deviations below what a pair at the threshold has."""
    p = threshold + (1 - threshold) / (1 << bits)
    return int(n * p - deviations * (n * p * (1 - p)) ** 0.5)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a`` and ``b`` whose full sets are similar enough, with all their columns.
    ``sets`` has ``doc_id`` and ``set``."""
    of = lambda x: sets.select(F.col("doc_id").alias(x), F.col("set").alias(f"set_{x}")).hint("merge")
    both = pairs.join(of("b"), "b").join(of("a"), "a").select(*pairs.columns, "set_a", "set_b")
    return both.mapInArrow(_similar(percent), pairs.schema)


def _hooked(links: DataFrame, label: str) -> DataFrame:
    """Per larger end of a link the smallest of the ends it is linked with, followed
    to that end's own for up to four links: ``id`` and ``up``.

    Ends that share ``up`` are linked, but not all that are linked share it; this is
    enough to see which pairs need no comparison. Columns ``a`` and ``b`` are the ends.
    """
    up = (
        links.select(F.greatest("a", "b").alias("id"), F.least("a", "b").alias("up"))
        .where("id <> up")
        .groupBy("id")
        .agg(F.min("up").alias("up"))
    )
    for _ in range(2):
        up = materialise(up, label)
        above = up.select(F.col("id").alias("up"), F.col("up").alias("upper"))
        up = up.join(above, "up", "left").select("id", F.coalesce("upper", "up").alias("up"))
    return up


def estimated(pairs: DataFrame, bits: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose packed bits leave them possible."""
    named = lambda x: bits.select(F.col("doc_id").alias(x), F.col("bits").alias(f"bits_{x}")).hint("merge")
    agree = agreeing(F.col("bits_a"), F.col("bits_b"))
    return (
        pairs.join(named("a"), "a")
        .join(named("b"), "b")
        .where(agree >= least_agreeing(threshold, MINIMA, BITS, 6))
        .select("a", "b")
        .distinct()
    )


def _open(members: DataFrame) -> DataFrame:
    """Members of bands with several components, with the number of blocks of the band."""
    several = (
        members.groupBy("band")
        .agg(F.count("*").alias("n"), F.min("component").alias("x"), F.max("component").alias("y"))
        .where("x <> y")
        .select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    rows = members.select("band", "doc_id", "component").join(several.hint("merge"), "band")
    return materialise(rows, "open-bands")


def _closer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = map(unpacked_set, batch.column(1).to_pylist())
        found = [np.concatenate([sketch(s), parity(s), [len(s)]]) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), _lists(found)], names=["doc_id", "set", "sketch"]
        )


def _tried(rows: DataFrame, sets: DataFrame, bits: DataFrame, percent: int, turn: int) -> DataFrame:
    """Links between each node of an open band and, of the nodes of other components that
    lead its bands in this turn, the one whose packed bits agree with its own the most;
    ``x`` and ``y`` are their components."""
    node = F.struct(F.xxhash64("doc_id", F.lit(turn)), "doc_id", "component")
    leaders = rows.groupBy("band").agg(F.min(node).alias("lead"))
    leaders = leaders.select(
        "band", F.col("lead.doc_id").alias("a"), F.col("lead.component").alias("x")
    )
    of = lambda x: bits.select(F.col("doc_id").alias(x), F.col("bits").alias(f"bits_{x}")).hint("merge")
    leaders = leaders.join(of("a"), "a")
    agree = agreeing(F.col("bits_a"), F.col("bits_b"))
    first = F.max(F.struct(agree, "a", "x", "component")).alias("first")
    pairs = (
        rows.join(leaders.hint("merge"), "band")
        .where("component <> x")
        .join(of("doc_id").withColumnRenamed("bits_doc_id", "bits_b"), "doc_id")
        .groupBy(F.col("doc_id").alias("b"))
        .agg(first)
        .select("first.a", "b", "first.x", F.col("first.component").alias("y"))
    )
    return materialise(confirmed(pairs, sets, percent), "tried-links")


def _relabelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Open rows after links, which tie whole components. These must all be followed:
    a leader that many are linked with may have any place in the order of ids."""
    tied = components(links.select(F.col("x").alias("a"), F.col("y").alias("b")))
    now = tied.select(F.col("id").alias("component"), F.col("component").alias("up"))
    moved = rows.drop("blocks").join(now, "component", "left")
    moved = moved.select("band", "doc_id", F.coalesce("up", "component").alias("component"))
    return _open(materialise(moved, "moved"))


def _remaining(rows: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Possible pairs of two components that meet in a band, each in its first one only."""
    own = rows.groupBy("doc_id").agg(F.sort_array(F.collect_set("band")).alias("bands"))
    known = own.join(sets.select("doc_id", "sketch").hint("merge"), "doc_id")
    rows = rows.join(known.hint("merge"), "doc_id")
    of = lambda x: (
        F.col("doc_id").alias(x),
        F.col("component").alias(f"of_{x}"),
        F.col("bands").alias(f"bands_{x}"),
        *sketch_columns(F.col("sketch"), f"sketch_{x}"),
    )
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = rows.select("band", block.alias("block"), *of("a"))
    right = rows.select("band", every.alias("block"), *of("b"))
    agree = agreeing_closer("sketch_a", "sketch_b")
    near = possible("sketch_a", "sketch_b", threshold) & (
        agree >= least_agreeing(threshold, CLOSER, 1, 5)
    )
    met = (left.band == right.band) & (left.block == right.block)
    once = F.get(F.array_intersect("bands_a", "bands_b"), F.lit(0)) == left.band
    pairs = left.join(right.hint("merge"), met & (F.col("of_a") < F.col("of_b")) & near & once)
    return pairs.select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75
) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked if 100 times their common shingles reach ``percent``
    times those of both. ``component_id`` is the smallest id that a document
    reaches over links, and ``kept`` marks the document that has it.
    """
    threshold = percent / 100
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text")
    )
    features = materialise(texts.mapInArrow(_features, BANDED), "features")
    known = features.where("doc_id IS NOT NULL AND n_shingles > 0")

    # One node per set. Rows of an equal set are combined before the shuffle.
    one = F.min_by(F.struct("bands", "bits"), "doc_id").alias("one")
    nodes = known.groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), one)
    nodes = materialise(nodes.select("set_key", "doc_id", "one.*"), "nodes")
    classes = nodes.select("set_key", F.col("doc_id").alias("first"))
    bits = nodes.select("doc_id", "bits")

    banded = nodes.select("doc_id", F.explode("bands").alias("band"))
    shared = (
        banded.groupBy("band")
        .agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("last"))
        .where("leader <> last")
        .drop("last")
    )
    members = materialise(banded.join(shared.hint("merge"), "band"), "members")
    involved = members.select("doc_id").distinct()
    sets = texts.join(involved.hint("merge"), "doc_id").select("doc_id", "text")
    sets = materialise(sets.mapInArrow(_sets, "doc_id bigint, set binary"), "sets")

    stars = (
        members.groupBy(F.col("doc_id").alias("b"))
        .agg(F.min("leader").alias("a"))
        .where("a <> b")
        .select("a", "b")
    )
    star_pairs = materialise(estimated(stars, bits, threshold), "star-pairs")
    star_links = materialise(confirmed(star_pairs, sets, percent), "star-links")
    # An id whose rows have different sets ties the classes of these sets.
    several = known.groupBy("doc_id").agg(F.min("set_key.a").alias("x"), F.max("set_key.a").alias("y"))
    several = several.where("x <> y").select("doc_id")
    tied = (
        known.join(several, "doc_id", "left_semi")
        .join(classes, "set_key")
        .select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    )
    links = star_links.unionByName(tied)

    labels = _hooked(star_links, "star-labels").withColumnRenamed("id", "doc_id")
    labelled = members.join(labels, "doc_id", "left")
    rows = _open(labelled.withColumn("component", F.coalesce("up", "doc_id")))
    nodes_left = rows.select("doc_id").distinct()
    closer = sets.join(nodes_left.hint("merge"), "doc_id").select("doc_id", "set")
    closer = closer.mapInArrow(_closer, "doc_id bigint, set binary, sketch array<bigint>")
    closer = materialise(closer, "open-sets")
    least = GAIN * closer.count()
    for turn in range(TRIES):
        tried = _tried(rows, closer, bits, percent, turn)
        links = links.unionByName(tried.select("a", "b"))
        rows = _relabelled(rows, tried)
        if tried.count() <= least:
            break
    rest = materialise(_remaining(rows, closer, threshold), "rest-pairs")
    links = links.unionByName(confirmed(rest, closer, percent))
    found = components(links)
    of_class = classes.join(found.withColumnRenamed("id", "first"), "first", "left").select(
        "set_key", F.coalesce("component", "first").alias("component_id")
    )
    own = F.coalesce("component_id", "doc_id")
    return features.join(of_class, "set_key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), own).alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"),
    )
