import random
import re
import time
from html import unescape
from itertools import product

import numpy as np
import pytest

from snipmill.llm import html_text as h

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def trees(spark):
    return h.train(spark.read.parquet(f"{SF}/pages.parquet"))


def text_of(trees, html):
    page = h.Page(html)
    return page.text(page.kept(trees.odds(page.features())))


def test_articles_of_the_table(spark, trees):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r.page_id: r.text for r in h.main_text(pages, trees).collect()}
    for row in pages.collect():
        article = re.search("<article>(.*)</article>", row.html, re.S)[1]
        plain = re.sub("<[^>]*>", " ", re.sub("</?b>", "", article))
        assert found[row.page_id] == " ".join(unescape(plain).split())


def test_other_markup(trees):
    body = "This is a sentence of the article, and it has some more words. " * 6
    html = f"""<html><head><title>t</title></head><body>
      <div id=site-header><a href=/>Home</a> <a href=/b>B</a></div>
      <div class="cookie-notice">We use cookies.</div>
      <article class="post"><h2>A title</h2><p>{body}<p>Second &amp; <i>la</i>st &#233;.
      <div class="comments"><p>{body} says a reader</p></div></article>
      <div class="sidebar"><ul><li><a href=x>one</a><li><a href=y>two</a></ul></div>
      <form><input name=q>Search</form><footer>c 2024</footer></body></html>"""
    assert text_of(trees, html) == f"A title {body}Second & last é.".strip()


def test_choice_is_the_best_consistent_one():
    draw = np.random.default_rng(1)
    for _ in range(60):
        n = int(draw.integers(1, 9))
        page = h.Page("")
        page.tags, page.parents = ["x"] * n, [-1] + [int(draw.integers(0, i)) for i in range(1, n)]
        odds = draw.normal(size=n)
        best = max(
            (sum(o if c else -o for o, c in zip(odds, chosen)), chosen)
            for chosen in product([True, False], repeat=n)
            if chosen[0] and all(chosen[page.parents[i]] or not chosen[i] for i in range(1, n))
        )
        assert page.kept(odds) == list(best[1])


def test_broken_markup(trees):
    for html in ("", "text", "<", "<p", "</p></div>x", "<!-- open", "<script>x", "a<b", "<p class='x>y</p>",
                 "<a href='>' title=\">\">z</a>", "&lt;b&gt; &nope; &#0;", "<table><tr><td>1<td>2<tr><td>3"):
        assert isinstance(text_of(trees, html), str)
    page = h.Page("a<br>b<i>c</i><p>d  e<p>f")
    assert page.text([True] * len(page.tags)) == "a bc d e f"


def test_large_pages_take_linear_time(trees):
    start = time.time()
    for html in ("<div>" * 30_000 + "x", "<b>" * 30_000 + "<p>x" * 30_000, '<a "' * 50_000,
                 "<!-- " * 50_000, "</i>" * 50_000, "<div>" * 20_000 + "</p>" * 20_000):
        h.Page(html).features()
    assert time.time() - start < 20


def test_odd_rows(spark, trees):
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "", "x"), (2, "u", "<p>a", "x")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = h.main_text(df, trees).collect()
    assert [(r.page_id, r.url) for r in found] == [r[:2] for r in rows]
    assert [r.text for r in found[:3]] == ["", "", ""]
    assert h.main_text(df.limit(0), trees).count() == 0
    only_names = h.train(df)
    assert text_of(only_names, "<div class=ad>x</div><p>y</p>") == "y"
    assert h.train(df.limit(0)).start == 0.0


def test_boosting_learns_and_trees_are_walked_right():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > -0.2)).astype(float)
    trees = h.boosted(x, y)
    assert ((trees.odds(x) > 0) == y).mean() > 0.97
    assert len(trees.odds(x[:0])) == 0


def test_grafts_keep_the_article(trees):
    draw = np.random.default_rng(3)
    html = "<article><p>" + "words of an article " * 5 + "</p></article>"
    changed = [h.grafted(html, draw) for _ in range(20)]
    assert all(html[:-10] in c for c in changed) and all(len(c) > len(html) for c in changed)
    assert h.grafted("<p>no article</p>", draw) == "<p>no article</p>"
    assert random.Random(0)
