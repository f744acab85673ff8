"""Strict decoding of strings that hold a JSON list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text is parsed inside an outer list that ends with this marker. Trailing
# junk, which the parser would skip, moves the marker and is thereby detected.
_MARKER = "\x1fend of text\x1f"
_MARKER_JSON = ',"\\u001fend of text\\u001f"]'


def json_string_items(text: Column) -> Column:
    """String items of a JSON list; null when the text is not one JSON list.

    Items of any other type are left out, never converted.
    """
    outer = F.try_parse_json(F.concat(F.lit("["), text, F.lit(_MARKER_JSON))).try_cast(
        "array<variant>"
    )
    marker = F.get(outer, F.lit(1)).cast("string")
    whole = (F.size(outer) == 2) & (marker == _MARKER)
    items = F.when(whole, F.get(outer, F.lit(0)).try_cast("array<variant>"))
    strings = F.filter(items, lambda v: F.schema_of_variant(v) == "STRING")
    return F.transform(strings, lambda v: v.cast("string"))
