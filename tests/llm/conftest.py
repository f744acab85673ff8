from __future__ import annotations

import pytest

LONG = "word " * 30_000 + "end"
# Columns that the operators' results have too.
EXTRA = "lang string, source string, n_chars bigint, kept boolean, score double, ids string, band int"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds documents of (doc_id, text), with further columns of clashing names."""

    def build(rows):
        full = [(i, t, None, "s", None, True, 0.5, "x", 1) for i, t in rows]
        return spark.createDataFrame(full, f"doc_id bigint, text string, {EXTRA}")

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Missing, empty and very long texts, ties, repeated rows and missing ids."""
    plain = "one two three four five six seven eight nine ten eleven twelve"
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, plain), (4, plain), (5, plain.upper()),
        (None, plain), (None, None), (6, LONG), (7, LONG), (8, "ünï cödé 😀\x00 <|endoftext|> x"),
    ]
