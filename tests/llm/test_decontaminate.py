import random
import re

import duckdb
import pytest

from laying import every_laying
from snipmill.llm import decontaminate as d
from snipmill.llm.oracle import ORACLE

VOCABULARY = [f"w{i}" for i in range(400)]


def items_of(spark, items):
    return spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, doc_id int")


@pytest.fixture(scope="module")
def planted():
    draw = random.Random(3)
    items = [(k, " ".join(draw.choice(VOCABULARY) for _ in range(draw.randrange(4, 40)))) for k in range(12)]
    docs = []
    for i in range(36):
        words = [draw.choice(VOCABULARY) for _ in range(draw.randrange(0, 90))]
        if i % 3 == 0:
            passage = draw.choice(items)[1].split()
            for _ in range(draw.randrange(0, 1 + len(passage) // 5)):
                passage[draw.randrange(len(passage))] = "other"
            at = draw.randrange(len(words) + 1)
            words[at:at] = [x.upper() + "," for x in passage]
        docs.append((i, " ".join(words)))
    return docs, items


def found(documents, spark, docs, items):
    rows = d.overlaps(documents(docs), items_of(spark, items)).collect()
    out = {(r.doc_id, r.item_id): (r.equal_words, r.layings) for r in rows}
    assert len(out) == len(rows)
    return out


def test_overlaps_equal_brute_force(spark, documents, planted):
    docs, items = planted
    wanted = every_laying(docs, items)
    assert len(wanted) >= 6
    assert found(documents, spark, docs, items) == wanted


@pytest.mark.parametrize("words", [60, 8])
def test_blocks_find_the_same(spark, documents, planted, monkeypatch, words):
    """Also where items are longer than a block and no join is broadcast."""
    docs, items = planted
    monkeypatch.setattr(d, "BLOCK_WORDS", words)
    if words == 8:
        items = items[:4]
        monkeypatch.setattr(d.F, "broadcast", lambda df: df.hint("merge"))
    assert found(documents, spark, docs, items) == every_laying(docs, items)


def test_substitutions_and_clean_documents(spark, documents):
    item = " ".join(VOCABULARY[:20])
    words = VOCABULARY[:20]
    two = [w if i not in (4, 11) else "zz" for i, w in enumerate(words)]
    half = [w if i % 2 else "zz" for i, w in enumerate(words)]
    docs = [(1, "start " + " ".join(two) + " end"), (2, " ".join(half)), (3, "clean text"), (None, item), (4, None)]
    df, items = documents(docs), items_of(spark, [(7, item), (None, item), (8, None), (9, "")])
    assert [(r.doc_id, r.item_id) for r in d.overlaps(df, items).collect()] == [(1, 7)]
    kept = d.clean(df, items)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [2, 3, 4]


def test_odd_rows(spark, documents, odd_rows):
    items = items_of(spark, [(1, odd_rows[3][1]), (1, odd_rows[3][1]), (2, "word " * 40)])
    rows = d.overlaps(documents(odd_rows), items).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(4, 1), (5, 1), (6, 2), (7, 2)]
    assert d.overlaps(documents([]), items).count() == 0
    assert d.overlaps(documents(odd_rows), items.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, documents, planted):
    docs, items = planted
    plan = d.overlaps(documents(docs), items_of(spark, items))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


def test_texts_under_one_id_are_judged_alone(spark, documents):
    item = " ".join(VOCABULARY[:20])
    df = documents([(1, item), (1, "clean text"), (None, item), (None, "clean too"), (None, None)])
    kept = d.clean(df, items_of(spark, [(7, item)])).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, ""), (0, "clean too"), (1, "clean text")]


def test_twin_finds_short_and_repetitive_items(spark, documents, tmp_path):
    """The SQL twin and the operator on what the tables hold none of."""
    draw = random.Random(9)
    items = [(1, "yes no yes no yes no yes"), (2, "word " * 30), (3, "one two three"), (4, "solo"), (5, " ".join(VOCABULARY[:30]))]
    docs = [(k, f"start {t} end") for k, (_, t) in enumerate(items)]
    docs += [(20 + k, " ".join(w if draw.random() > 0.2 else "z" for w in VOCABULARY[:30])) for k in range(12)]
    docs += [(50, "yes no " * 9), (51, "word " * 99), (51, "x"), (52, ""), (53, None)]
    for name in ("documents", "benchmark"):
        table = documents(docs) if name == "documents" else items_of(spark, items)
        table.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    twin = connection.execute(ORACLE["op7_spaced_seeds"]).fetchall()
    assert {(a, b): (e, n) for a, b, e, _, n in twin} == every_laying(docs, items)
    assert {(a, b): (e, n) for a, b, e, _, n in twin} == found(documents, spark, docs, items)
