"""Strings: lines and white space as Python understands them."""

import hashlib
import random

from pyspark.sql import functions as F

from snipmill.functions.hashing import draw, fingerprint
from snipmill.functions.json_lists import json_string_items
from snipmill.functions.text import (
    is_closed,
    is_visible,
    lines,
    non_blank,
    pieces,
    strip,
    unify_line_ends,
)

ALPHABET = [
    *(chr(c) for c in range(0x09, 0x0E)), *(chr(c) for c in range(0x1C, 0x21)),
    *map(chr, (0x85, 0xA0, 0x1680, 0x2000, 0x200A, 0x200B, 0x2028, 0x2029, 0x3000)),
    "\r\n", "\n", "a", "b", "é", "\U0001f600",
]
EDGES = ["", "\n", "a\n\n", "a\r\nb", "a\rb", "\r\n", " ", "\n\r", "a\x0b", "\x1ca\x85"]


def random_texts(n=3000, seed=7):
    dice = random.Random(seed)
    return EDGES + [
        "".join(dice.choice(ALPHABET) for _ in range(dice.randrange(14))) for _ in range(n)
    ]


def test_lines_and_strip_match_python(column):
    texts = random_texts()
    found = column(
        [(t,) for t in texts], "t string",
        lines(F.col("t")), strip(F.col("t")),
        non_blank(F.col("t")), is_visible(F.col("t")),
    )
    for text, (its_lines, stripped, something, visible) in zip(texts, found):
        assert its_lines == text.splitlines(), repr(text)
        assert stripped == text.strip(), repr(text)
        assert something == (text.strip() or None), repr(text)
        assert visible == bool(text.strip()), repr(text)


def test_every_character_of_the_basic_plane(column):
    texts = [f"x{chr(c)}y{chr(c)}" for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    found = column(
        [(t,) for t in texts], "t string", F.size(lines(F.col("t"))), strip(F.col("t"))
    )
    for text, (count, stripped) in zip(texts, found):
        assert count == len(text.splitlines()), repr(text)
        assert stripped == text.strip(), repr(text)


def test_unified_text_has_the_same_lines(column):
    texts = random_texts(500, seed=3)
    unified = unify_line_ends(F.col("t"))
    found = column([(t,) for t in texts], "t string", pieces(unified), is_closed(unified))
    for text, (its_pieces, closed) in zip(texts, found):
        assert its_pieces == text.splitlines() + [""] * closed


def test_null_stays_null(column):
    assert column([(None,)], "t string", lines(F.col("t")), strip(F.col("t"))) == [(None, None)]


def test_fingerprint_is_sha256_of_utf8(column):
    texts = random_texts(200)
    found = column([(t,) for t in texts], "t string", fingerprint(F.col("t")))
    assert found == [hashlib.sha256(t.encode()).hexdigest() for t in texts]


def test_draw_depends_on_salt_and_key(column):
    found = column(
        [("a",), ("b",)], "k string", draw("s", F.col("k")), draw("t", F.col("k"))
    )
    assert found[0][0] == hashlib.md5(b"s|a").hexdigest()
    assert len({v for row in found for v in row}) == 4


def test_json_lists_are_strict(column):
    cases = {
        '["a",1,null,"b"]': ["a", "b"],
        "['a']": None,
        '"str"': None,
        "[]": [],
        '["x"] junk': None,
        '["a"],["b"]': None,
        '["a"]],[["b"]': None,
        "": None,
        None: None,
        '{"a": ["b"]}': None,
        ' ["x", ["y"]] ': ["x"],
        '["\\u00e9\\n", ""]': ["é\n", ""],
        "1": None,
        "null": None,
        '["open': None,
        '["5", true]': ["5"],
    }
    found = column([(c,) for c in cases], "j string", json_string_items(F.col("j")))
    assert found == list(cases.values())
