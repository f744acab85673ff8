"""Content fingerprints and reproducible random order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fingerprint(content: Column) -> Column:
    """Hex SHA-256 of the UTF-8 bytes, with no normalisation."""
    return F.sha2(content, 256)


def draw(salt: str | Column, key: Column) -> Column:
    """Pseudo-random sort key of a row: uniform hex digits, fixed by salt and key.

    Sorting by it shuffles, and its smallest n values are a sample of size n
    without replacement. A re-run task produces the same values again, so a
    lost executor cannot change a selection.
    """
    prefix = F.lit(salt) if isinstance(salt, str) else salt
    return F.md5(F.concat_ws("|", prefix, key))
