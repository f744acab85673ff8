import random

import numpy as np
import public_tokenizers
import pytest

from snipmill.llm import attribution as a

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    with open(PATH) as file:
        return a.encoding(file.read(), public_tokenizers.PATTERN)


def brute(text, encoder, sizes):
    """Each token alone: letters that end in it, and how many of them each section has."""
    ends = a.sections_of(text).tolist()
    letters = np.cumsum([len(c.encode()) for c in text]).tolist()
    counts, crossing, at = [0] * len(ends), [0] * len(ends), 0
    for i in encoder.encode_ordinary(text):
        begin = sum(x <= at for x in letters)
        at += int(sizes[i])
        end = sum(x <= at for x in letters)
        shares = [max(0, min(end, e) - max(begin, b)) for b, e in zip([0, *ends], ends)]
        if any(shares):
            k = shares.index(max(shares))
        else:
            k = next(j for j, e in enumerate(ends) if e > begin)
        counts[k] += 1
        crossing[k] += sum(s > 0 for s in shares) > 1
    return counts, crossing


def test_counts_equal_brute_force(encoder):
    draw = random.Random(3)
    parts = ["\n", "\n\n", "a", " ", "é", "😀", "word", " the", ".\n", " \n ", "\n\n\n"]
    crossed = 0
    for _ in range(1500):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(14)))
        counts, crossing = a.attributed(a.token_ends(text, *encoder), a.sections_of(text))
        assert (counts.tolist(), crossing.tolist()) == brute(text, *encoder)
        crossed += crossing.sum()
    assert crossed > 20


def test_boundary_rule():
    ends = np.array([4, 5, 10])
    # 0-3 inside, 3-6 has one letter in each of three sections, 6-10 inside, and 2-5 mostly first.
    counts, crossing = a.attributed(np.array([3, 6, 10]), ends)
    assert counts.tolist() == [2, 0, 1] and crossing.tolist() == [1, 0, 0]


def test_rows_of_a_table(spark, documents, odd_rows, encoder):
    rows = a.section_tokens(documents(odd_rows), PATH, public_tokenizers.PATTERN).collect()
    wanted = []
    for i, t in odd_rows:
        ends = a.sections_of(t or "")
        n = len(encoder[0].encode_ordinary(t or ""))
        wanted.append((i, len(ends), n))
    found, at = [], 0
    for i, sections, n in wanted:
        part = rows[at : at + sections]
        at += sections
        assert [r.section for r in part] == list(range(sections))
        found.append((part[0].doc_id, len(part), sum(r.n_tokens for r in part)))
    assert found == wanted and at == len(rows)
    assert a.section_tokens(documents([]), PATH, public_tokenizers.PATTERN).count() == 0
