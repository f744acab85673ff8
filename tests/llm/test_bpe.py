import hashlib
import random
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from snipmill.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [*" \n\t\r\x0b\x0c\x1c\x85\xa0 　aAzé1²½九'sdt-_,.!<|>ß́😀\x00﻿", "<|endoftext|>", "'ll", "  "]


@pytest.fixture(scope="module")
def both():
    return bpe.vocabulary(bpe.read_vocabulary(PATH)), Tokenizer.from_file(PATH)


def ids(own, text):
    return list(array("i", own.encode(text)))


def test_random_texts_as_the_library(both):
    own, library = both
    draw = random.Random(5)
    for _ in range(3000):
        text = "".join(draw.choice(PARTS) for _ in range(draw.randrange(25)))
        wanted = library.encode(text, add_special_tokens=False).ids
        assert ids(own, text) == wanted
        assert own.decode(wanted) == library.decode(wanted, skip_special_tokens=False)


def test_ids_that_are_no_whole_letters_decode_as_in_the_library(both):
    own, library = both
    draw = random.Random(6)
    for _ in range(2000):
        some = [draw.randrange(50257) for _ in range(4)]
        assert own.decode(some) == library.decode(some, skip_special_tokens=False)
    assert own.decode([-1, 10**6, 64]) == own.decode([64])


def test_one_long_piece(both):
    own, library = both
    text = "xAb7" * 20_000 + "z" * 50_000
    assert ids(own, text) == library.encode(text, add_special_tokens=False).ids


def test_tree_finds_the_leftmost_lowest_pair():
    draw = random.Random(7)
    for _ in range(200):
        ranks = [draw.choice([None, *range(5)]) for _ in range(draw.randrange(1, 20))]
        tree = bpe.MergeTree(ranks)
        for _ in range(10):
            known = [(r, i) for i, r in enumerate(ranks) if r is not None]
            assert tree.lowest() == (min(known)[1] if known else -1)
            at = draw.randrange(len(ranks))
            ranks[at] = draw.choice([None, *range(5)])
            tree.put(at, ranks[at])


def test_what_is_forgotten_is_encoded_again(both, monkeypatch):
    own, library = both
    monkeypatch.setattr(bpe, "KEPT_CHUNKS", 3)
    text = " ".join(f"w{i}" for i in range(50)) * 2
    assert ids(own, text) == library.encode(text, add_special_tokens=False).ids


def test_round_trip_of_odd_rows(spark, documents, odd_rows, both):
    _, library = both
    found = bpe.round_trip(documents(odd_rows), PATH)
    assert found.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    rows = found.withColumn("d", bpe.ids_digest(found.ids)).collect()
    assert len(rows) == len(odd_rows)
    for (doc_id, text), row in zip(odd_rows, rows):
        wanted = library.encode(text or "", add_special_tokens=False).ids
        assert (row.doc_id, row.n_tokens, row.ids) == (doc_id, len(wanted), wanted)
        assert row.decoded == (text or "")
        assert row.d == hashlib.sha256(",".join(map(str, wanted)).encode()).hexdigest()
    assert bpe.round_trip(documents([]), PATH).count() == 0


def test_column_functions(spark, documents, odd_rows):
    encode, decode = bpe.encoder(spark, PATH), bpe.decoder(spark, PATH)
    df = documents(odd_rows)
    rows = df.select("text", decode(encode(df.text)["ids"]).alias("back")).collect()
    assert all(r.back == (r.text or "") for r in rows)


def test_other_vocabularies_are_refused():
    with pytest.raises((ValueError, KeyError)):
        bpe.Vocabulary(bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json")))
