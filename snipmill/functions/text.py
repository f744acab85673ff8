"""String expressions over whole texts and their lines.

Every function takes and returns a ``Column``. Spark's own ``trim`` removes
only U+0020 and its line handling knows only a few line ends, so white space
and line ends are spelled out here.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points that end a line ("\r\n" is one end) ...
LINE_ENDS = "".join(
    map(chr, (0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x85, 0x2028, 0x2029))
)
# ... and code points that count as white space, line ends included.
WHITE_SPACE = "".join(
    map(
        chr,
        (
            *range(0x09, 0x0E),
            *range(0x1C, 0x21),
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ),
    )
)

_ANY_LINE_END = r"\r\n|[" + "".join(f"\\x{{{ord(c):x}}}" for c in LINE_ENDS) + "]"


def strip(text: Column) -> Column:
    """Text without leading and trailing white space."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_visible(text: Column) -> Column:
    """Whether there is anything but white space; stops at the first such character."""
    return F.ltrim(text, F.lit(WHITE_SPACE)) != ""


def non_blank(text: Column) -> Column:
    """Stripped text, or null when nothing but white space is left."""
    return F.when(is_visible(text), strip(text))


def unify_line_ends(text: Column) -> Column:
    """Text in which every line end is a single newline.

    The regular expression runs only on texts that hold an unusual line end;
    ``contains`` finds those with plain byte comparisons.
    """
    unusual = reduce(or_, (text.contains(c) for c in LINE_ENDS if c != "\n"))
    return F.when(unusual, F.regexp_replace(text, _ANY_LINE_END, "\n")).otherwise(text)


def pieces(text: Column) -> Column:
    """What lies between the line ends of a text with unified ones.

    These are its lines, and an empty piece more if the text :func:`is_closed`.
    """
    return F.split(text, "\n", -1)


def is_closed(text: Column) -> Column:
    """Whether no line is left open: a final line end opens no further line."""
    return (text == "") | text.endswith("\n")


def lines(text: Column) -> Column:
    """Array of lines without their ends; none for the empty text."""
    unified = unify_line_ends(text)
    split = pieces(unified)
    return F.when(is_closed(unified), F.slice(split, 1, F.size(split) - 1)).otherwise(split)
