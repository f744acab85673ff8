"""Overlaps against laying every item over every word of every document."""

import random
from itertools import combinations

import pytest

from laying import every_laying
from snipmill.llm import decontaminate as d

VOCABULARY = [f"w{i}" for i in range(400)]


def found(documents, spark, docs, items):
    items = spark.createDataFrame(items, "item_id bigint, text string")
    rows = d.overlaps(documents(docs), items).collect()
    out = {(r.doc_id, r.item_id): (r.equal_words, r.layings) for r in rows}
    assert len(out) == len(rows)
    return out


def substituted(words, at):
    return " ".join("other" if j in at else w for j, w in enumerate(words))


def missed(length, masks, percent=75):
    """Ways to substitute words of a stretch that passes, of which no mask hits."""
    most = length - -(-percent * length // 100)
    for at in combinations(range(length), most):
        if not any(
            all(m == "0" or s + j not in at for j, m in enumerate(mask))
            for mask in masks
            for s in range(length - len(mask) + 1)
        ):
            yield at


def test_masks_lose_no_substitutions_in_a_window():
    assert len(list(combinations(range(13), 3))) == 286
    assert not list(missed(13, d.masks_of(13, 75)))


def test_every_way_to_substitute_three_words(spark, documents):
    item = VOCABULARY[:13]
    docs = [(i, substituted(item, at)) for i, at in enumerate(combinations(range(13), 3))]
    periodic = VOCABULARY[20:320]
    docs += [(1000 + k, substituted(periodic, range(k, 300, 4))) for k in range(4)]
    items = [(1, " ".join(item)), (2, " ".join(periodic))]
    rows = found(documents, spark, docs, items)
    assert rows == every_laying(docs, items)
    assert len(rows) == 290


@pytest.mark.parametrize("words", [1_000_000, 200])
def test_repeated_words_are_found(spark, documents, monkeypatch, words):
    monkeypatch.setattr(d, "BLOCK_WORDS", words)
    draw = random.Random(5)
    bits = [" ".join(draw.choice(["yes", "no"]) for _ in range(40)) for _ in range(3)]
    runs = ["word " * 40, "yes no " * 20, "0 0 0 1 " * 8, "a b c " * 9, "x " * 9 + "y " * 20 + "x " * 7]
    items = list(enumerate(bits + runs + [" ".join(VOCABULARY[:20])]))
    docs = [(k, f"{a} start {t} end {t}") for k, (a, t) in enumerate((draw.choice(VOCABULARY), t) for _, t in items)]
    docs += [(50, "word " * 300), (51, "word " * 150 + "x " + "word " * 100), (52, "x " * 70 + "y " * 90)]
    docs += [(53, " ".join(draw.choice("ab") for _ in range(200))), (54, "word " * 12), (55, "no yes " * 90)]
    assert found(documents, spark, docs, items) == every_laying(docs, items)


def test_seeds_of_one_word_are_joined_once_per_laying(spark, documents):
    """The rows grow with the words of document and item, not with their product."""
    docs = documents([(1, "word " * d.PIECE)]).select("doc_id", d.word_hashes("text").alias("words"))
    items = spark.createDataFrame([(1, "word " * 500)], "item bigint, text string")
    items = items.select("item", d.word_hashes("text").alias("item_words"))
    masks = {mask: [13] for mask in d.masks_of(13, 75)}
    hits = d._doc_seeds(docs, masks, 13).join(d._item_seeds(items, masks, 13), "seed")
    assert 0 < hits.count() <= len(masks) * (500 + d.PIECE)


def test_masks_lose_no_substitutions_in_short_items():
    for length in range(1, 14):
        assert not list(missed(length, d.masks_of(length, 75)))
    for length in range(1, 12):
        for percent in range(1, 101, 7):
            assert not list(missed(length, d.masks_of(length, percent), percent))


def test_short_items_are_found(spark, documents):
    items, docs = [], []
    for n in range(1, 13):
        words = [f"i{n}x{j}" for j in range(n)]
        items.append((n, " ".join(words)))
        for at in combinations(range(n), n - -(-75 * n // 100)):
            docs.append((len(docs), f"some {substituted(words, at)} words"))
        docs.append((len(docs), f"some {substituted(words, range(1 + n - -(-75 * n // 100)))} words"))
    rows = found(documents, spark, docs, items)
    assert rows == every_laying(docs, items)
    assert len(rows) == len(docs) - 12
