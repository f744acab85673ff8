import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from snipmill.llm import minhash
from snipmill.llm.graph import components


def shingle_set(text):
    w = (text or "").encode().lower().split()
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows, percent=75):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingle_set(t))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def edited(draw, words, n):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def rows():
    """Groups of copies with few and many edits, a passage that many share, short texts."""
    draw = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = [draw.choice(vocabulary) for _ in range(60)]
    out, i = [], 100
    for _ in range(25):
        base = [draw.choice(vocabulary) for _ in range(draw.randrange(20, 200))]
        for _ in range(draw.randrange(1, 9)):
            words = edited(draw, base, draw.randrange(0, 1 + len(base) // 18))
            out.append((i, " ".join(words)))
            i += 1
    for _ in range(40):
        out.append((i, " ".join(passage + [draw.choice(vocabulary) for _ in range(60)])))
        i += 1
    base = [draw.choice(vocabulary) for _ in range(100)]
    for _ in range(60):
        out.append((i, " ".join(edited(draw, base, 3))))
        i += 1
    draw.shuffle(out)
    return out


def check(documents, rows):
    found = minhash.near_duplicates(documents(rows)).collect()
    wanted = brute(rows)
    assert len(found) == len(rows)
    sizes = sorted((i or 0, len(shingle_set(t))) for i, t in rows)
    assert sorted((r.doc_id or 0, r.n_shingles) for r in found) == sizes
    for r in found:
        assert r.component_id == (None if r.doc_id is None else wanted[r.doc_id])
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)


def test_components_equal_brute_force(spark, documents, rows):
    check(documents, rows)


def test_large_bands_in_blocks(spark, documents, rows, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    check(documents, rows)


def test_odd_rows(spark, documents, odd_rows):
    check(documents, [r for r in odd_rows if len(r[1] or "") < 1000])
    check(documents, [(4, "a b c d e f g"), (4, "h i j k l m n"), (9, "a b c d e f g"), (3, "h i j k l m n")])
    assert minhash.near_duplicates(documents([])).count() == 0


def test_long_texts(spark, documents):
    text = " ".join(f"w{i}" for i in range(40_000))
    check(documents, [(1, text), (2, text + " more"), (3, "other")])


def test_estimates_follow_similarity():
    draw = np.random.default_rng(3)
    for share in (0.5, 0.75, 0.95):
        errors = []
        for _ in range(40):
            n = 2000
            both = round(2 * n * share / (1 + share))
            a = np.unique(draw.integers(0, 1 << 63, 2 * n - both, np.uint64))
            x, y = a[:n], np.concatenate([a[:both], a[n:]])
            bits = minhash.minima([x, y]) & np.uint32(3)
            agree = (bits[0] == bits[1]).mean()
            errors.append((agree - 0.25) / 0.75 - share)
        assert abs(np.mean(errors)) < 0.05


def test_packed_sets_and_bits(spark):
    values = np.unique(np.random.default_rng(4).integers(0, 1 << 63, 500, np.uint64))
    short = values >> np.uint64(16)
    assert (minhash.unpacked_set(minhash.packed_set(values)) == short).all()
    a, b = minhash.sketch(short), minhash.sketch(short[: len(short) * 3 // 4])
    same = minhash.CLOSER - sum(bin(int(x) & (1 << 64) - 1).count("1") for x in a ^ b)
    assert abs(same / minhash.CLOSER * 2 - 1 - 0.75) < 0.08
    low = minhash.minima([values, values[::2]])
    bits = minhash.packed_bits(low).tolist()
    df = spark.createDataFrame([(bits[0], bits[1])], "a array<bigint>, b array<bigint>")
    found = df.select(minhash.agreeing(F.col("a"), F.col("b")).alias("n")).head().n
    assert found == int(((low[0] & 3) == (low[1] & 3)).sum())


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(100, 150)]
    edges += [(300, 301), (301, 302), (302, 300), (300, 300), (400, 400)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r.id: r.component for r in components(df).collect()}
    assert len(found) == 61 + 51 + 3
    assert all(found[i] == 0 for i in range(61)) and found[302] == 300 and found[200] == 100
    assert components(df.limit(0)).count() == 0


def test_join_of_sketches_is_compiled(spark):
    """Java interprets methods of more than 8000 bytes, in which a pair takes ten times as long."""
    rows = spark.createDataFrame([(1, 5, 5, 1)], "band bigint, doc_id bigint, component bigint, blocks int")
    sets = spark.createDataFrame([(5, [0] * (minhash.CLOSER // 64))], "doc_id bigint, sketch array<bigint>")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pairs = minhash._remaining(rows, sets, 0.75)
        text = spark._jvm.PythonSQLUtils.explainString(pairs._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_rounds_end_when_little_is_closed(spark, documents, monkeypatch):
    """Texts that share a passage but are not alike: one round closes nothing, so none follows."""
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = [draw.choice(vocabulary) for _ in range(100)]
    rows = [(i, " ".join(passage + [draw.choice(vocabulary) for _ in range(30)])) for i in range(60)]
    turns, tried = [], minhash._tried
    monkeypatch.setattr(minhash, "_tried", lambda *a: turns.append(a[-1]) or tried(*a))
    check(documents, rows)
    assert turns == [0]


def test_parity_never_exceeds_the_difference(spark):
    draw = np.random.default_rng(5)
    rows, wanted = [], []
    for _ in range(200):
        n = int(draw.integers(1, 3000))
        x = np.unique(draw.integers(0, 1 << 48, n, np.uint64))
        cut = int(draw.integers(0, 1 + len(x) // 3))
        y = np.unique(np.concatenate([x[cut:], draw.integers(0, 1 << 48, cut // 2, np.uint64)]))
        if not len(y):
            continue
        p, q = minhash.parity(x), minhash.parity(y)
        both = len(np.intersect1d(x, y))
        assert sum(bin(int(v) & (1 << 64) - 1).count("1") for v in p ^ q) <= len(x) + len(y) - 2 * both
        blank = [0] * (minhash.CLOSER // 64)
        rows.append((blank + p.tolist() + [len(x)], blank + q.tolist() + [len(y)]))
        wanted.append(both / (len(x) + len(y) - both))
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>")
    columns = [*minhash.sketch_columns(F.col("a"), "a"), *minhash.sketch_columns(F.col("b"), "b")]
    found = [r.ok for r in df.select(columns).select(minhash.possible("a", "b", 0.75).alias("ok")).collect()]
    assert all(ok for ok, similar in zip(found, wanted) if similar >= 0.75)
    assert not all(found)


def test_groups_almost_alike_do_not_meet_pair_by_pair(spark, documents, monkeypatch):
    """Two groups of copies, at 0.70 of each other: their pairs do not leave the last join."""
    words = [f"w{i}" for i in range(150)]
    other = [f"v{i}" if i in (20, 45, 70, 95, 120) else w for i, w in enumerate(words)]
    rows = [(2 * i, " ".join([*words[:-1], f"x{i}"])) for i in range(60)]
    rows += [(2 * i + 1, " ".join([*other[:-1], f"y{i}"])) for i in range(60)]
    made, keep = {}, minhash.materialise

    def counted(df, label):
        out = keep(df, label)
        made[label] = out.count()
        return out

    monkeypatch.setattr(minhash, "materialise", counted)
    check(documents, rows)
    assert made["open-bands"] > 60 and made["rest-pairs"] <= len(rows)
