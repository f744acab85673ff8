"""Runs against trying every period at every word."""

import random
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from snipmill.llm import periodic
from snipmill.llm.common import Numbering


def brute(words):
    """Runs as (start, period, length): every period, and its smallest one per stretch."""
    n, runs = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                own = words[i : i + length]
                if not any(own[d:] == own[:-d] for d in range(1, q)):
                    runs.append((i, q, length))
            i = max(j, i) + 1
    return sorted(runs)


def rewritten(doc_id, words):
    words, n = list(words), len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    return words


def kept(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + k for s, q, k in runs)]


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def wanted(doc_id, text):
    words = rewritten(doc_id, split(text))
    runs = brute(words)
    best = max(runs, key=lambda r: (Fraction(r[2], r[1]), -r[0], -r[1]), default=None)
    figures = (None,) * 4 if best is None else (best[0], best[2], best[1], 1000 * best[2] // best[1])
    lines = "".join(f"{s},{k},{q}\n" for s, q, k in runs)
    digest = lambda t: sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *figures, digest(lines), digest(" ".join(kept(words, runs))))


def found(df):
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    made = df.withColumn("text", periodic.with_period(F.col("text"), h))
    rows = periodic.summary(periodic.periodic_runs(made, finish=lambda t: F.sha2(t, 256))).collect()
    return sorted(map(tuple, rows), key=repr)


def repetitive(draw):
    """Words with planted repetitions of all periods, nested, next to and over each other."""
    words = [f"w{draw.randrange(30)}" for _ in range(draw.randrange(0, 40))]
    for _ in range(draw.randrange(4)):
        unit = [draw.choice("abcdef") for _ in range(draw.choice([1, 1, 2, 3, 4, 5, 8, 9, 16, 17, 31]))]
        if draw.random() < 0.3:
            unit = unit * draw.randrange(1, 4) + [draw.choice("xyz")]
        whole = unit * draw.randrange(2, 12)
        words += whole[draw.randrange(len(unit)) : len(whole) - draw.randrange(len(unit))]
        words += [draw.choice("abw")] * draw.randrange(3)
    return words


def all_runs(words):
    """Runs by tiles alone, stitched with plain lists."""
    numbers = Numbering()
    ids = np.array([numbers[w] for w in words], np.int32)
    parts = {}
    for t in periodic.tiles_of(ids):
        own = np.frombuffer(t["words"], "<i4").tolist()
        bounds = np.frombuffer(t["bounds"], "<i4").tolist()
        for q, a, b in periodic.solved(own, t["octave"], t["start"], bounds):
            parts.setdefault(q, []).append((a, b))
    runs = []
    for q, own in parts.items():
        whole = []
        for a, b in sorted(own):
            if whole and a <= whole[-1][1]:
                whole[-1][1] = max(b, whole[-1][1])
            else:
                whole.append([a, b])
        runs += [(a, q, b - a + q) for a, b in whole if b - a + q >= max(6, 4 * q)]
    return sorted(runs)


def test_tiles_equal_brute_force():
    draw = random.Random(4)
    seen = set()
    for _ in range(700):
        words = repetitive(draw)
        runs = brute(words)
        assert all_runs(words) == runs
        seen |= {q for _, q, _ in runs}
    for size in (1, 2, 3):
        for _ in range(700):
            words = [draw.choice("abc"[:size]) for _ in range(draw.randrange(80))]
            assert all_runs(words) == brute(words)
    assert {1, 2, 3, 5, 8, 9, 16, 17, 31} <= seen


def test_z_function_equals_its_definition():
    draw = random.Random(6)
    for _ in range(200):
        w = [draw.randrange(2) for _ in range(draw.randrange(1, 40))]
        z = periodic.z_function(w, len(w))
        for i in range(1, len(w)):
            k = z[i]
            assert w[:k] == w[i : i + k] and (i + k == len(w) or w[k] != w[i + k])


def test_query_equals_brute_force(spark, documents):
    draw = random.Random(8)
    rows = [(i, " ".join(repetitive(draw))) for i in range(300)]
    rows += [(i, " ".join(f"v{draw.randrange(400)}" for _ in range(draw.randrange(300)))) for i in range(300, 500)]
    result = found(documents(rows))
    assert result == sorted((wanted(*r) for r in rows), key=repr)
    assert sum(r[1] > 0 for r in result) > 150


def test_very_long_texts(spark, documents):
    base = [f"w{i}" for i in range(5_000)]
    rows = [
        (1, "word " * 30_000), (2, " ".join(base * 5)), (3, "a b " * 15_000 + "c " + "a b " * 4),
        (4, " ".join(base) + " x" * 9), (6, " ".join(base[:300] * 9)),
    ]
    runs = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic.periodic_runs(documents(rows)).collect()}
    assert runs == {
        1: [(0, 1, 30_000)], 2: [(0, 5_000, 25_000)], 3: [(0, 2, 30_000), (30_001, 2, 8)],
        4: [(5_000, 1, 9)], 6: [(0, 300, 2_700)],
    }


def test_odd_rows(spark, documents, odd_rows):
    rows = [r for r in odd_rows if len(r[1] or "") < 1000]
    rows += [(7, "A a A a a a a a a"), (7, "x y x y z"), (9, "\x1cq " * 6), (None, "go " * 7)]
    assert found(documents(rows)) == sorted((wanted(*r) for r in rows), key=repr)
    assert found(documents([])) == []
    result = periodic.periodic_runs(documents([(1, " go \n go\tgo go go go "), (2, None)])).collect()
    assert sorted((r.doc_id, r.collapsed) for r in result) == [(1, "go"), (2, "")]


@pytest.mark.parametrize("tiled", [(0, 4), (3, 9), (4, 9), (9, 12)])
def test_fragments_that_touch_are_one(spark, tiled):
    parts = [(1, 2, 0, 4), (1, 2, *tiled), (1, 3, 20, 30), (2, 2, 1, 9), (2, 2, 12, 30)]
    df = spark.createDataFrame(parts, "row bigint, period int, start int, stop int")
    rows = {tuple(r) for r in periodic.stitched(df).collect()}
    assert {(2, 1, 2, 10), (2, 12, 2, 20), (1, 20, 3, 13)} <= rows
    assert ((1, 0, 2, 11) in rows) == (tiled[1] == 9)
