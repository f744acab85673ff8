"""Language-model scores by deleted interpolation (Jelinek and Mercer, 1980).

The probability of a token after the token before it mixes maximum-likelihood
estimates of three orders: the bigram, the unigram and the uniform distribution
over the vocabulary and one unknown word. The mixture weights depend on how often
the context was seen, in buckets of powers of two. They are learned by
expectation-maximisation on counts that were kept out: a tenth of the training
texts is deleted from the counts, and the weights that explain it best are used
with the counts of all training texts.

Counts cover the whole corpus and stay distributed. Texts are gathered in blocks
of a bounded number of tokens, one row each. A block sends its distinct n-grams,
as sorted 64-bit hashes cut by hash ranges, to the range's task. That task adds
up all blocks and answers each block with the totals of just the n-grams it
asked for, and the block scores its texts. So a frequent word is one key per block
and never a hot group, no vocabulary is broadcast, and a task holds one block or
one hash range at a time. The driver gets four totals, and the held-out events
counted by bucket and rounded probabilities, of which there is a bounded number.

Results, defined for every input: a null text is an empty text, and an empty text
is its end alone. A missing id counts as training text and is returned as null.
Repeated rows are counted and scored each time. Without any training text all
probability is uniform. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snipmill.llm.common import Numbering, hashes, mixed, texts_of
from snipmill.session import materialise

RETAINED, DELETED, SCORED = 0, 1, 2  # what a block is for
BLOCK_TOKENS = 1_000_000
RANGE_TOKENS = 2_000_000  # tokens of the corpus per hash range, on average
FREQUENCIES = 24  # buckets of context frequencies: unseen, 1, 2-3, 4-7 and so on
STEPS = 8  # held-out probabilities are told apart by so many steps per power of e
ROUNDS = 60  # of expectation-maximisation

END, BEGIN = np.uint64(0x9D39247E33776D41), np.uint64(0x2AF7398005AAA5C7)
_LEFT, _RIGHT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)

BLOCKS = "block bigint, role int, ids array<bigint>, lengths array<int>, tokens binary, keys binary"
ASKED = "n int, hash_range int, block bigint, role int, keys binary, counts binary"
TOLD = (
    "n int, hash_range int, block bigint, role int, counts binary, retained binary, "
    "types bigint, tokens bigint, retained_types bigint, retained_tokens bigint"
)
EVENTS = "bucket int, q1 int, q2 int, times bigint"
SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers by byte planes, compressed."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(planes.tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


class _Block:
    """Texts of one role, gathered until they have enough tokens."""

    def __init__(self):
        self.ids, self.rows, self.size, self.numbers = [], [], 0, Numbering()

    def add(self, doc_id: int | None, text: bytes) -> None:
        words = text.lower().split()
        self.ids.append(doc_id)
        row = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
        self.rows.append(row)
        self.size += len(row) + 1

    def row(self, block: int, role: int) -> dict:
        """Words are numbered by frequency, so that most numbers are small."""
        tokens = np.concatenate(self.rows)
        order = np.argsort(-np.bincount(tokens, minlength=len(self.numbers)), kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        return {
            "block": block,
            "role": role,
            "ids": self.ids,
            "lengths": [len(r) for r in self.rows],
            "tokens": pack(place[tokens]),
            "keys": hashes(self.numbers)[order].tobytes(),
        }


def _arrow(rows: list[dict], ddl_types: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(ddl_types))


_INTS, _LONGS = pa.int32(), pa.int64()
_BLOCK_TYPES = [
    ("block", _LONGS), ("role", _INTS), ("ids", pa.list_(_LONGS)), ("lengths", pa.list_(_INTS)),
    ("tokens", pa.binary()), ("keys", pa.binary()),
]
_ASKED_TYPES = [
    ("n", _INTS), ("hash_range", _INTS), ("block", _LONGS), ("role", _INTS),
    ("keys", pa.binary()), ("counts", pa.binary()),
]
_TOLD_TYPES = [
    *_ASKED_TYPES[:4], ("counts", pa.binary()), ("retained", pa.binary()), ("types", _LONGS),
    ("tokens", _LONGS), ("retained_types", _LONGS), ("retained_tokens", _LONGS),
]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the texts of a task; their numbers are unique in the table."""
    part, made, open_blocks = TaskContext.get().partitionId(), 0, {}
    for batch in batches:
        ids, roles = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for doc_id, text, role in zip(ids, texts_of(batch.column(1)), roles):
            block = open_blocks.setdefault(role, _Block())
            block.add(doc_id, text)
            if block.size >= BLOCK_TOKENS:
                yield _arrow([open_blocks.pop(role).row((part << 24) + made, role)], _BLOCK_TYPES)
                made += 1
    for role, block in open_blocks.items():
        yield _arrow([block.row((part << 24) + made, role)], _BLOCK_TYPES)
        made += 1


def _one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of a batch, of which each is large."""
    for i in range(len(batch)):
        yield batch.slice(i, 1).to_pylist()[0]


class _Grams:
    """N-grams of a block. Two more words stand for the end and the begin of a text."""

    def __init__(self, row: dict):
        own = np.frombuffer(row["keys"], np.uint64)
        self.keys = np.concatenate([own, [END, BEGIN]])
        lengths = np.asarray(row["lengths"], np.int64)
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths
        n, end = int(self.ends[-1]) + 1, len(own)
        self.word = np.full(n, end, np.int32)
        inside = np.ones(n, bool)
        inside[self.ends] = False
        self.word[inside] = unpack(row["tokens"]).view(np.int64)
        self.before = np.empty(n, np.int32)
        self.before[1:] = self.word[:-1]
        self.before[self.starts] = end + 1

    def bigrams(self, inverse: bool = False):
        """Sorted keys of distinct bigrams, and their counts or where each token's is."""
        codes = self.before.astype(np.int64) * len(self.keys) + self.word
        if inverse:
            codes, where = np.unique(codes, return_inverse=True)
        else:
            codes, counts = np.unique(codes, return_counts=True)
        before, word = np.divmod(codes, len(self.keys))
        keys = mixed(self.keys[before] * _LEFT + self.keys[word] * _RIGHT)
        order = np.argsort(keys)
        if not inverse:
            return keys[order], counts[order]
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        return keys[order], place[where]


def _asked(bits: int):
    """Distinct n-grams of each block by hash range, with their counts in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _one_by_one(batch):
                grams = _Grams(row)
                order = np.argsort(grams.keys)
                single = np.bincount(grams.word, minlength=len(order))
                single[-1] = len(grams.ends)  # each text begins once
                found = [(1, grams.keys[order], single[order]), (2, *grams.bigrams())]
                for n, keys, counts in found:
                    if row["role"] == SCORED:
                        counts = np.zeros_like(counts)
                    tops = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
                    cuts = [0, *np.searchsorted(keys, tops), len(keys)]
                    out = []
                    for r, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        if a < b:
                            gaps = np.diff(keys[a:b], prepend=np.uint64(0))
                            out.append(
                                {"n": n, "hash_range": r, "block": row["block"], "role": row["role"],
                                 "keys": pack(gaps), "counts": pack(counts[a:b])}
                            )
                    yield _arrow(out, _ASKED_TYPES)

    return run


def _told(table: pa.Table) -> pa.Table:
    """Totals over all blocks for one hash range, for each block what it asked for."""
    rows = table.to_pylist()
    keys = [np.cumsum(unpack(r["keys"])) for r in rows]
    known, where = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.concatenate([unpack(r["counts"]) for r in rows]).astype(np.float64)
    kept = np.repeat([r["role"] == RETAINED for r in rows], [len(k) for k in keys])
    total = np.bincount(where, counts, len(known)).astype(np.uint64)
    retained = np.bincount(where, counts * kept, len(known)).astype(np.uint64)
    out, at = [], 0
    for row, own in zip(rows, keys):
        mine = where[at : at + len(own)]
        at += len(own)
        out.append(
            {"n": row["n"], "hash_range": row["hash_range"], "block": row["block"],
             "role": row["role"], "counts": pack(total[mine]),
             "retained": pack(retained[mine]) if row["role"] == DELETED else None}
        )
    if rows[0]["n"] == 1:
        own = known != BEGIN
        out[0] |= {
            "types": int((total[own] > 0).sum()),
            "tokens": int(total[own].sum()),
            "retained_types": int((retained[own] > 0).sum()),
            "retained_tokens": int(retained[own].sum()),
        }
    return pa.Table.from_pylist(out, schema=pa.schema(_TOLD_TYPES))


def bucket(context: np.ndarray) -> np.ndarray:
    """Bucket of how often a context was seen."""
    seen = np.maximum(context, 0.5)
    return np.minimum(np.floor(np.log2(seen)).astype(np.int64) + 1, FREQUENCIES - 1)


def _found(row: dict, field: str) -> tuple[_Grams, np.ndarray, np.ndarray, np.ndarray]:
    """A block's n-grams and, per token, the counts of word, context and bigram."""
    grams = _Grams(row)
    answers = sorted(row["answers"], key=lambda a: (a["n"], a["hash_range"]))
    told = {
        n: np.concatenate([unpack(a[field]) for a in answers if a["n"] == n]).astype(np.float64)
        for n in (1, 2)
    }
    single = np.empty(len(grams.keys))
    single[np.argsort(grams.keys)] = told[1]
    _, where = grams.bigrams(inverse=True)
    return grams, single[grams.word], single[grams.before], told[2][where]


def _held_out_events(tokens: int):
    """Held-out tokens counted by bucket and rounded logarithms of both estimates."""

    def rounded(x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.where(x > 0, np.round(np.log(x) * STEPS), 1).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _one_by_one(batch):
                _, word, context, pair = _found(row, "retained")
                q1 = rounded(word / max(tokens, 1))
                q2 = rounded(pair / np.maximum(context, 1))
                codes = (bucket(context) << 40) + (-q1 + 1 << 20) + (-q2 + 1)
                codes, times = np.unique(codes, return_counts=True)
                low = (1 << 20) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((codes >> 40).astype(np.int32)),
                        pa.array((1 - (codes >> 20 & low)).astype(np.int32)),
                        pa.array((1 - (codes & low)).astype(np.int32)),
                        pa.array(times.astype(np.int64)),
                    ],
                    names=["bucket", "q1", "q2", "times"],
                )

    return run


def learned_weights(events: np.ndarray, types: int) -> np.ndarray:
    """Weights of uniform, unigram and bigram per bucket, by expectation-maximisation.

    ``events`` has columns bucket, q1, q2 and times. A bucket without events takes
    the weights of the one below it.
    """
    weights = np.tile([0.1, 0.9, 0.0], (FREQUENCIES, 1))
    for b in range(FREQUENCIES):
        own = events[events[:, 0] == b]
        if not len(own):
            if b > 1:
                weights[b] = weights[b - 1]
            elif b == 1:
                weights[b] = [0.05, 0.6, 0.35]
            continue
        q = own[:, 1:3]
        p = np.exp(q / STEPS) * (q <= 0)
        p = np.column_stack([np.full(len(own), 1 / (types + 1)), p])
        now = np.array([0.1, 0.5, 0.4]) if b else np.array([0.1, 0.9, 0.0])
        for _ in range(ROUNDS):
            shares = p * now
            shares /= shares.sum(axis=1, keepdims=True)
            now = (shares * own[:, 3:]).sum(axis=0) / own[:, 3].sum()
        now = 0.999 * now + 0.001 * np.array([0.5, 0.5, 0.0])  # nothing is impossible
        weights[b] = now
    return weights


def _scored(types: int, tokens: int, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _one_by_one(batch):
                grams, word, context, pair = _found(row, "counts")
                base = np.log10((word + 0.5) / (tokens + 0.5 * (types + 1)))
                if tokens:
                    uniform, unigram, bigram = (w[bucket(context)] for w in weights.T)
                    # A context that was never seen leaves its bigram's share to the unigram.
                    unigram += bigram * (context == 0)
                    p = uniform / (types + 1) + unigram * word / tokens
                    p += bigram * pair / np.maximum(context, 1)
                else:
                    p = np.ones(len(word))
                at = grams.starts
                n = grams.ends - grams.starts + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["ids"], pa.int64()),
                        pa.array([row["role"] == SCORED] * len(n)),
                        pa.array(n),
                        pa.array(np.add.reduceat((word > 0).astype(np.int64), at)),
                        pa.array(np.full(len(n), tokens, np.int64)),
                        pa.array(np.add.reduceat(base, at)),
                        pa.array(np.add.reduceat(np.log10(p), at)),
                    ],
                    names=[f.split()[0] for f in SCORES.split(", ")],
                )

    return run


def deleted_interpolation(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, tokens, known tokens, training tokens, and the
    log10 probability of the text under add-half unigrams (``base_score``) and under
    the mixture (``score``). Rows where ``held_out`` is true are scored only.
    """
    spare = F.crc32(F.concat(F.lit("spare "), F.col(id_col).cast("string")).cast("binary")) % 10
    role = (
        F.when(F.coalesce(held_out, F.lit(False)), SCORED)
        .when(spare == 0, DELETED)
        .otherwise(RETAINED)
    )
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text_col).cast("binary").alias("text"),
        role.cast("int").alias("role"),
    )
    blocks = materialise(rows.mapInArrow(_blocks, BLOCKS), "blocks")
    size = blocks.agg(F.sum(F.size("ids") + F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("n"))
    n = size.head().n or 0
    bits = max(1, int(np.ceil(np.log2(max(n, 1) / RANGE_TOKENS + 1))))
    asked = blocks.mapInArrow(_asked(bits), ASKED)
    told = materialise(asked.groupBy("n", "hash_range").applyInArrow(_told, TOLD), "totals")
    names = ["types", "tokens", "retained_types", "retained_tokens"]
    totals = told.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names)).head()

    def answered(wanted: Column) -> DataFrame:
        """Blocks with the answers to them, which are as long as what they asked."""
        answers = (
            told.where(wanted)
            .groupBy("block")
            .agg(F.collect_list(F.struct("n", "hash_range", "counts", "retained")).alias("answers"))
        )
        return blocks.where(wanted).join(answers, "block")

    events = (
        answered(F.col("role") == DELETED)
        .mapInArrow(_held_out_events(totals.retained_tokens), EVENTS)
        .groupBy("bucket", "q1", "q2")
        .agg(F.sum("times").alias("times"))
        .collect()
    )
    table = np.array([tuple(e) for e in events], np.int64).reshape(-1, 4)
    weights = learned_weights(table, totals.retained_types)
    return answered(F.lit(True)).mapInArrow(
        _scored(totals.types, totals.tokens, weights), SCORES
    )
