"""Markup that hides text: drawings, objects, templates, heads; and pages without marks."""

import re
from html import unescape

import pytest

from snipmill.llm import html_text as h

SF = "/root/testdata/sf0.001"


def shown(html):
    page = h.Page(html)
    return page.text([True] * len(page.tags))


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>one</p><svg class=x/><p>two", "one two"),
        ("<p>one</p><svg class=x/><p>two</p><svg><path d=1 /><text>in</text></svg><p>three", "one two three"),
        ("<p>one</p><svg class=x><p>two</p><svg><g><title>t</title>in</g></svg><p>three", "one two three"),
        ("<svg><g><svg>a</svg>b</g>c</svg>d", "d"),
        ("<svg><foreignObject><p>in</p></foreignObject></svg>out", "out"),
        ("<p>one</p><object data=x><p>two</p><p>three</p>", "one two three"),
        ("<div>one<object>in</div><p>two</p><object>in</object>three", "one two three"),
        ("<div>one<canvas>in</div><p>two</p><canvas>in</canvas>three", "one two three"),
        ("<template><div>in</div></template>out<template>", "out"),
        ("<head><title>t</title><meta a=b><p>text</p>", "text"),
        ("<html><head><title>t</title><style>x</style> <b>te</b>xt<p>more", "text more"),
        ("<html><head><title>t</title> bare <p>more", "bare more"),
        ("<html><head><title>t</title></head><body>a</body>", "a"),
        ("<html><head><script>x</script><template><p>in</p></template><body>a", "a"),
    ],
)
def test_text_around_hidden_elements(html, text):
    assert shown(html) == text


def test_foreign_elements_are_no_blocks():
    page = h.Page("<div><svg><g><b>x</b></g></svg><object><p>y</p></object></div>")
    assert page.tags == ["#page", "div"] and page.inner == [0, 0]


def test_many_open_elements_take_linear_time():
    for html in ("<svg>" * 50_000, "<svg><g>" * 30_000 + "</svg>", "<object>" * 50_000 + "</object>", "<head>x" * 30_000):
        h.Page(html).features()


def bare(html, tag):
    """The page with its article renamed and without any class, id or role."""
    html = re.sub(r"<(/?)article>", rf"<\1{tag}>", html)
    return re.sub(r"""\s(?:class|id|role)=("[^"]*"|'[^']*'|[^\s"'>]+)""", "", html)


def test_pages_without_marks(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    trees = h.train(rows.where("page_id % 2 = 0"))
    pages = [(r.page_id, r.html) for r in rows.where("page_id % 2 = 1").collect()]
    wrong = 0
    for _, html in pages:
        article = re.search("<article>(.*)</article>", html, re.S)[1]
        plain = re.sub("<[^>]*>", " ", re.sub("</?b>", "", article))
        page = h.Page(bare(html, "div"))
        wrong += page.text(page.kept(trees.odds(page.features()))) != " ".join(unescape(plain).split())
    assert len(pages) > 100 and wrong == 0
