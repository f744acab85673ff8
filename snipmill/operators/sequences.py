"""Token id lists to fixed-length sequences with masks and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sequence length, and the label that a loss leaves out.
MAX_LENGTH = 512
IGNORED_LABEL = -100


def pad_id(pad: int | None, eos: int | None, vocabulary: int) -> int:
    """Id to pad with: the pad token, else the end token, else a new token."""
    return next((i for i in (pad, eos) if i is not None), vocabulary)


def _repeated(value: int, times: Column) -> Column:
    return F.array_repeat(F.lit(value), times.cast("int"))


def with_sequences(
    rows: DataFrame,
    pad: int,
    eos: int | None,
    length: int = MAX_LENGTH,
    ids: str = "token_ids",
) -> DataFrame:
    """Add ``input_ids`` and ``attention_mask``, both ``length`` long.

    No tokens: a single end token. Null (the text could not be tokenized): end
    tokens all along with an empty mask.
    """
    end = 0 if eos is None else eos
    tokens = F.when(F.size(ids) == 0, F.array(F.lit(end))).otherwise(F.col(ids))
    real = F.least(F.size(tokens), F.lit(length))
    room = length - real
    failed = F.col(ids).isNull()
    return rows.withColumn(
        "input_ids",
        F.when(failed, _repeated(end, F.lit(length))).otherwise(
            F.concat(F.slice(tokens, 1, length), _repeated(pad, room))
        ),
    ).withColumn(
        "attention_mask",
        F.when(failed, _repeated(0, F.lit(length))).otherwise(
            F.concat(_repeated(1, real), _repeated(0, room))
        ),
    )


def labels(ids: Column, pad: int) -> Column:
    """Training labels: the ids with every pad id out of the loss. An end token
    with the same id as the pad token is left out too."""
    return F.transform(ids, lambda i: F.when(i == pad, IGNORED_LABEL).otherwise(i))


def attended_labels(ids: Column, attention: Column) -> Column:
    """Training labels: the ids where there is attention, so that an end token counts
    also where it doubles as the pad token."""
    return F.zip_with(ids, attention, lambda i, a: F.when(a == 1, i).otherwise(IGNORED_LABEL))
