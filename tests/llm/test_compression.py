import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from snipmill.llm import compression
from snipmill.llm.compression import Bands


LETTERS = [chr(i) for i in range(0xA1, 0x7FF) if chr(i).isalpha()]


def prose(seed, n=400):
    draw = random.Random(seed)
    words = ["".join(draw.choice("etaoinshrdlu") for _ in range(draw.randrange(2, 9))) for _ in range(300)]
    return " ".join(draw.choice(words) for _ in range(n))


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(again),
        len(words) < 50 or 100 * len(again) > 50 * len(words),
    )


def test_figures_equal_brute_force(spark, documents, odd_rows):
    draw = random.Random(1)
    texts = ["".join(draw.choice(["a", "b", "c ", " ", "\n", "é", "#", "<>", "\x0b"]) for _ in range(60)) for _ in range(60)]
    rows = [*[r for r in odd_rows if len(r[1] or "") < 1000], *enumerate(texts, 100), (1000, "a b c a b c a b c")]
    df = documents(rows).select("text", compression.quality()(F.col("text")).alias("q"))
    for row in df.collect():
        q = row.q
        found = (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words, q.base_failed)
        assert found == brute(row.text)
        assert (q.ratio is None) == (not row.text)
        assert not (q.kept and q.base_failed)


def verdict(spark, documents, text):
    df = documents([(1, text)])
    return df.select(compression.quality()(F.col("text")).alias("q")).head().q


def test_prose_stays_and_extremes_go(spark, documents):
    draw = random.Random(2)
    noise = " ".join("".join(draw.choice(LETTERS) for _ in range(9)) for _ in range(300))
    distinct = " ".join(f"{i:05d}" for i in range(3000))
    assert verdict(spark, documents, prose(1)).kept
    assert verdict(spark, documents, prose(2, 60)).kept
    # Too many different letters to compress at all.
    assert not verdict(spark, documents, noise).kept
    assert not verdict(spark, documents, "same words again and again " * 200).kept
    # No repeated window, yet far too regular.
    regular = verdict(spark, documents, distinct)
    assert not regular.base_failed and not regular.kept


def test_junk_inside_a_long_text(spark, documents):
    text = prose(3, 2500)
    junk = text + " " + " ".join(f"a{i % 10} b{i} " + "-" * 60 for i in range(150))
    clean, mixed = verdict(spark, documents, text), verdict(spark, documents, junk)
    assert clean.kept and clean.n_chunks >= 5 and clean.chunks_outside == 0
    assert mixed.chunks_outside > 0


def test_bands_depend_on_length():
    bands = Bands()
    assert bands.of_length(0) == (0.0, 2.6) and bands.of_length(10**9) == (1.5, 4.5)
    with pytest.raises(ValueError):
        Bands(whole=((5, 0, 1),))


def test_empty_table(spark, documents):
    assert documents([]).select(compression.quality()(F.col("text"))).count() == 0
