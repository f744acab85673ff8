"""Helpers that several operators of this subpackage share.

Words are maximal runs of bytes other than ASCII white space; only A-Z are
lower-cased. In Python both are what ``bytes.split`` and ``bytes.lower`` do.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(doc_id: Column, folds: int = 5) -> Column:
    """Remainder of the CRC-32 of an id written as text; 0 for a missing id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def sampled(df: DataFrame, draw: str, n: int) -> DataFrame:
    """At most ``n`` rows, those with the smallest ``draw``, a 64-bit hash.

    Only draws below a bound that leaves about twice as many are sorted, so that
    the one task that picks the last rows gets no more from a larger table.
    """
    rows = df.count()
    share = min(1.0, 2 * n / rows + 1e-9) if rows else 1.0
    bound = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
    return df.where(F.col(draw) <= bound).orderBy(draw).limit(n)


def texts_of(array: pa.Array) -> list[bytes]:
    """Texts of an Arrow array as bytes; a null is an empty text."""
    return [x or b"" for x in array.cast(pa.binary()).to_pylist()]


class Numbering(dict):
    """Numbers keys from 0 in the order in which they are first looked up."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number


def hashes(words: Iterable[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, in place (a public finaliser of MurmurHash3)."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
