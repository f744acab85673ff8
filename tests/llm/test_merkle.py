"""The manifest against one built with plain lists and hashlib."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from snipmill.llm import merkle
from snipmill.llm.common import fold

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, tree int, pos int"


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def grown(digests):
    """Last node of a tree, and per leaf its siblings before and after, level by level."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        runs = [digests[i : i + 16] for i in range(0, len(digests), 16)]
        for path, i in zip(paths, at):
            run, slot = runs[i // 16], i % 16
            path.append(("".join(run[:slot]), "".join(run[slot + 1 :])))
        at = [i // 16 for i in at]
        digests = [digest("".join(run)) for run in runs]
    return digests[0], paths


def tampered(row):
    if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5:
        return row
    low = row[4] and "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
    return (*row[:4], low)


def wanted(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        own = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((own, *grown([leaf(r) for r in own])))
    root, ups = grown([t[1] for t in trees])
    out = []
    for (own, subroot, paths), up in zip(trees, ups):
        for row, path in zip(own, paths):
            x = leaf(tampered(row))
            for before, after in path + up:
                x = digest(before + x + after)
            proof = digest("".join(a + b for a, b in path + up))
            out.append((row[0], leaf(row), subroot, root, proof, x, x == root))
    return sorted(out, key=repr)


def found(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    text = merkle.lowered(F.col("text"), fold(F.col("doc_id")) == 0)
    result = merkle.manifest(df, changed={"text": text})
    assert result.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in result.collect()), key=repr)


def row(i, source, text="Some Text"):
    return (i, source, "en", len(text or ""), text)


def test_equals_plain_lists(spark):
    """Trees of one to four levels; one source holds most rows."""
    sizes = {"hot": 4200, "a": 257, "b": 256, "c": 17, "d": 16, "e": 2, "f": 1, "ü": 33, "z": 15}
    rows = [row(1000 * k + 7 * i, s, f"Text {i}") for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    random.Random(1).shuffle(rows)
    result = found(spark, rows)
    assert result == wanted(rows)
    assert {r[-1] for r in result} == {True, False}


def test_many_sources(spark):
    rows = [row(i, f"s{i}", "lower case") for i in range(300)]
    result = found(spark, rows)
    assert result == wanted(rows) and all(r[-1] for r in result)


@pytest.mark.parametrize("n", [1, 17])
def test_one_source(spark, n):
    rows = [row(i, "s") for i in range(n)]
    assert found(spark, rows) == wanted(rows)


def test_odd_rows(spark):
    """Nulls in every column, empty and very long texts, repeated ids and rows."""
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (None, "s", None, 3, "ABC"),
        (1, None, "", -5, ""), (1, "", "en", 0, "ÄB\x00😀"), (2, "s", "en", 1, "WORD " * 30_000),
        (3, "s", None, None, None), (3, "s", None, None, "Q"), (3, "s", None, None, "Q"), (-4, "s", "x", 2, "q"),
    ]
    assert found(spark, rows) == wanted(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_a_run_is_the_most_that_a_window_holds(spark):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in [row(i, "s") for i in range(40)]], SCHEMA)
    plan = merkle.manifest(df)._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line:
            assert "run#" in line.rpartition("], [")[0].rpartition("[")[2]
