"""Quoted attribute values of any length."""

import pytest

from snipmill.llm.html_text import Page


@pytest.mark.parametrize("quote", ['"', "'"])
@pytest.mark.parametrize("inside", ["<p>inside</p> ", "a > b "])
def test_long_quoted_values_belong_to_their_tag(quote, inside):
    html = f"<body><div class=story data-x = {quote}{inside * 2000}{quote} id=main>shown</div><p>end</p></body>"
    page = Page(html)
    assert page.tags == ["#page", "body", "div", "p"]
    assert {"story", "main"} <= page.tokens[2]
    assert page.text([True] * len(page.tags)) == "shown end"


def test_a_quote_that_never_closes_is_stray():
    page = Page('<body><div class="story>shown</div><p>' + "word " * 2000 + "</p></body>")
    assert page.tags == ["#page", "body", "div", "p"]
