"""Merkle manifest of a dataset: digests of rows, hashed upwards 16 by 16, with proofs.

Every row is a leaf. The leaves of a source, in the order of their ids, form a tree:
level by level each run of ``WIDTH`` consecutive nodes becomes their parent, until one
node, the subroot, remains. The subroots in the order of their sources form a tree in
the same way, and its last node is the root. A proof of a row is the list of siblings
on the way to the root; folding the leaf with them gives the root again only if the
row is what it was.

1. Rows are sorted by range, written, and numbered within their source by an offset
   per sorted part, so a source that holds most rows is spread over all parts.
2. Up: per level, a window over a run supplies the nodes at the fixed offsets 1 to 15
   behind and ahead (lag and lead), masked by the slot of a node in its run and by the
   length of the run. The first child of a run hashes the parent. A window never holds
   more than one run, so no task gets more than its share of a large source.
3. Down: paths are joined from the parents to their children, so what leaves have in
   common is kept once per parent and only reaches the leaves in the last join.

Digests travel as 32 bytes; hashed are their hexadecimal texts, as the manifest says.

Results, defined for every input: null values of a row are ``-`` in its leaf; null
sources form a tree of their own, which is first; rows without id come first in their
source. Rows that share source and id are ordered by their leaves, and equal rows are
leaves of their own. A source of one row has its leaf as its subroot. An empty table
has no rows and no root. Texts of any length are hashed whole. Further columns are
ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snipmill.llm.common import lower_ascii
from snipmill.session import materialise

WIDTH = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    text = value.cast("string")
    framed = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.when(text.isNull(), F.lit("-")).otherwise(framed)


def leaf_of(*values: Column) -> Column:
    """Digest of a row, as bytes: every value with its length in front, so that no two
    rows are hashed from the same text."""
    return F.unhex(F.sha2(F.concat(*map(_field, values)), 256))


def hexadecimal(digests: Column) -> Column:
    """Digests that follow each other, as lower-case text."""
    return F.lower(F.hex(digests))


def hashed(digests: Column) -> Column:
    """Digest, as bytes, of the texts of digests that follow each other."""
    return F.unhex(F.sha2(hexadecimal(digests), 256))


def _nothing() -> Column:
    return F.lit("").cast("binary")


def _positions(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Add ``pos``, from 0, of a row in its tree, and ``n``, the rows of the tree.

    The rows must be a written table: their place in it settles ties.
    """
    order = [tree, *order, "_row"]
    placed = rows.withColumn("_row", F.monotonically_increasing_id())
    sort = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = materialise(
        sort.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}).drop("_row"),
        "merkle-sorted",
    )
    of_tree = Window.partitionBy(tree)
    before = of_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        ordered.groupBy(tree, "_part")
        .agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
        .select(
            tree,
            "_part",
            (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_rows").over(of_tree).alias("n"),
        )
    )
    numbered = ordered.join(materialise(parts, "merkle-parts"), [tree, "_part"])
    return numbered.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def _slot() -> Column:
    return F.col("pos") % WIDTH


def _run_length() -> Column:
    return F.least(F.lit(WIDTH), F.col("n") - F.col("pos") + _slot())


def _ahead(nodes: Window) -> Column:
    """Digests of the nodes of the run behind a node in order, in one piece."""
    some = [
        F.when(_slot() + k < _run_length(), F.lead("digest", k).over(nodes))
        for k in range(1, WIDTH)
    ]
    return F.concat(*(F.coalesce(x, _nothing()) for x in some))


def _behind(nodes: Window) -> Column:
    """Digests of the nodes of the run in front of a node in order, in one piece."""
    some = [
        F.when(_slot() >= k, F.lag("digest", k).over(nodes)) for k in range(WIDTH - 1, 0, -1)
    ]
    return F.concat(*(F.coalesce(x, _nothing()) for x in some))


def _in_runs(nodes: DataFrame) -> tuple[DataFrame, Window]:
    placed = nodes.withColumn("run", F.floor(F.col("pos") / WIDTH).cast("bigint"))
    return placed, Window.partitionBy("tree", "run").orderBy("pos")


def _parents(nodes: DataFrame) -> DataFrame:
    """One node per run, made by its first child."""
    placed, window = _in_runs(nodes.where("n > 1").select("tree", "pos", "n", "digest"))
    return (
        placed.withColumn("ahead", _ahead(window))
        .where(_slot() == 0)
        .select(
            "tree",
            F.col("run").alias("pos"),
            F.ceil(F.col("n") / WIDTH).cast("bigint").alias("n"),
            hashed(F.concat("digest", "ahead")).alias("digest"),
        )
    )


def _levels(leaves: DataFrame) -> list[DataFrame]:
    """Nodes of all trees by level. Of a tree, the level where ``n`` is 1 is the last."""
    levels = [leaves]
    most = leaves.agg(F.max("n")).head()[0] or 0
    while most > 1:
        levels.append(materialise(_parents(levels[-1]), "merkle-level"))
        most = -(-most // WIDTH)
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    """The last node of each tree."""
    ends = (level.where("n = 1").select("tree", "digest") for level in levels)
    return reduce(DataFrame.unionByName, ends)


def _paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Leaves with ``path``, the siblings before and after a node of the way up, level by
    level, and all that ``tops`` has of their tree, whose own path follows."""
    more = [c for c in tops.columns if c not in ("tree", "path")]
    above = None
    for k, level in reversed(list(enumerate(levels))):
        lone = level.where("n = 1").join(tops, "tree")
        found = lone.select(*level.columns, "path", *more)
        if above is not None:
            placed, window = _in_runs(level.where("n > 1"))
            sides = F.struct(_behind(window).alias("behind"), _ahead(window).alias("ahead"))
            shared = above.select("tree", F.col("pos").alias("run"), F.col("path").alias("_up"), *more)
            # Both sides of the join are dealt by tree and run, as the window needs it.
            joined = placed.withColumn("_own", sides).join(shared.hint("merge"), ["tree", "run"])
            path = F.concat(F.array("_own"), F.col("_up")).alias("path")
            found = found.unionByName(joined.select(*level.columns, path, *more))
        above = materialise(found.drop("digest", "n"), "merkle-paths") if k else found
    return above


def manifest(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, changed: dict[str, Column] | None = None
) -> DataFrame:
    """Per row: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (of all its
    siblings), and ``folded_root``, the root as it follows from the siblings and the row
    with the values of ``changed``; all as hexadecimal texts. ``fields`` begin with the
    columns of id and source."""
    doc_id, source = fields[:2]
    now = changed or {}
    leaves = materialise(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            # A struct that holds a null equals another one, unlike a bare null.
            F.struct(F.col(source).alias("source")).alias("tree"),
            leaf_of(*map(F.col, fields)).alias("digest"),
            leaf_of(*(now.get(f, F.col(f)) for f in fields)).alias("now"),
        ),
        "merkle-leaves",
    )
    levels = _levels(_positions(leaves, "tree", ["doc_id", "digest"]))
    subroots = materialise(_tops(levels), "merkle-subroots").withColumnRenamed("tree", "_source")
    above = _levels(_positions(subroots.withColumn("tree", F.lit(0)), "tree", ["_source"]))
    sides = "array<struct<behind:binary,ahead:binary>>"
    root = _tops(above).select("tree", F.col("digest").alias("root"), F.array().cast(sides).alias("path"))
    tops = _paths(above, root).select(
        F.col("_source").alias("tree"), F.col("digest").alias("subroot"), "root", "path"
    )
    rows = _paths(levels, materialise(tops, "merkle-tops"))
    siblings = F.aggregate("path", _nothing(), lambda all_, s: F.concat(all_, s["behind"], s["ahead"]))
    folded = F.aggregate("path", F.col("now"), lambda x, s: hashed(F.concat(s["behind"], x, s["ahead"])))
    return rows.select(
        "doc_id",
        hexadecimal(F.col("digest")).alias("leaf"),
        hexadecimal(F.col("subroot")).alias("subroot"),
        hexadecimal(F.col("root")).alias("root"),
        F.sha2(hexadecimal(siblings), 256).alias("proof_sha256"),
        hexadecimal(folded).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def lowered(text: Column, tampered: Column) -> Column:
    """A text with A-Z in lower case where ``tampered`` is true."""
    return F.when(tampered, lower_ascii(text)).otherwise(text)
