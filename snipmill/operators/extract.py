"""From source rows of three shapes to one uniform record per snippet.

The shape of a field is known from the schema, so each choice between a text, a
list and a nested field is made once, when the plan is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    StringType,
    StructType,
)

from snipmill.functions.json_lists import json_string_items
from snipmill.functions.text import is_visible, non_blank, strip
from snipmill.sources.registry import SOLUTION_LISTS, TAGGED_SOLUTIONS, Source

# Shortest content kept, and what joins several solutions.
MIN_CONTENT_LENGTH = 20
SOLUTIONS_JOINT = "\n\n---\n\n"

# Fields that may hold the id of a row, best first.
ID_FIELDS = ("id", "name", "problem_id")


def _type_of(schema: StructType, field: str) -> DataType | None:
    return schema[field].dataType if field in schema.fieldNames() else None


def _is_text(data_type: DataType | None) -> bool:
    return isinstance(data_type, StringType)


def _is_list_of(data_type: DataType | None, element: type[DataType]) -> bool:
    return isinstance(data_type, ArrayType) and isinstance(data_type.elementType, element)


def joined_items(items: Column) -> Column:
    """Non-blank items of a list, stripped, one per line.

    Null when the list is null or holds a null: such a list does not count as
    present. A list with nothing but blanks counts, and gives the empty text.
    """
    kept = F.transform(F.filter(items, is_visible), strip)
    return F.when(F.forall(items, lambda item: item.isNotNull()), F.array_join(kept, "\n"))


def first_text(schema: StructType, fields: tuple[str, ...]) -> Column:
    """First text field with visible content; lists count only when there is none."""
    texts = [non_blank(F.col(f)) for f in fields if _is_text(_type_of(schema, f))]
    lists = [
        joined_items(F.col(f)) for f in fields if _is_list_of(_type_of(schema, f), StringType)
    ]
    return F.coalesce(*texts, *lists, F.lit(None).cast("string"))


def all_texts(schema: StructType, fields: tuple[str, ...], separator: str | None) -> Column:
    """All fields with visible content in their order, joined by the separator."""
    parts = []
    for field in fields:
        if _is_text(_type_of(schema, field)):
            parts.append(non_blank(F.col(field)))
        elif _is_list_of(_type_of(schema, field), StringType):
            parts.append(F.nullif(joined_items(F.col(field)), F.lit("")))
    return F.nullif(F.concat_ws(separator or "\n", *parts), F.lit(""))


def normalised_label(label: Column) -> Column:
    """Language label in lower case without the digit 3 and spaces; any label
    that speaks of C++ is ``cpp``."""
    plain = F.lower(label)
    for dropped in ("3", " "):
        plain = F.replace(plain, F.lit(dropped), F.lit(""))
    return F.when(plain.contains("c++"), "cpp").otherwise(plain)


def first_tagged_solution(schema: StructType, source: Source) -> Column:
    """First solution with visible code whose label names the wanted language."""
    element = schema[source.solutions_field].dataType.elementType
    wanted = source.language.lower()

    def matches(label: Column) -> Column:
        return normalised_label(label) == wanted

    def wanted_code(entry: Column) -> Column:
        label = entry[source.language_key]
        if _is_list_of(element[source.language_key].dataType, StringType):
            named = F.exists(label, matches)
        else:
            named = matches(label)
        return named & is_visible(entry[source.code_key])

    found = F.get(F.filter(source.solutions_field, wanted_code), F.lit(0))
    return strip(found[source.code_key])


def joined_solution_lists(schema: StructType, field: str) -> Column:
    """All solutions of a list of solution lists, each list decoded or in JSON.

    Solutions are not stripped, empty ones stay. Null when there is none.
    """
    data_type = _type_of(schema, field)
    if _is_list_of(data_type, StringType):
        decoded = F.transform(field, json_string_items)
    elif _is_list_of(data_type, ArrayType) and _is_text(data_type.elementType.elementType):
        decoded = F.transform(
            field, lambda items: F.filter(items, lambda item: item.isNotNull())
        )
    else:
        return F.lit(None).cast("string")
    solutions = F.flatten(F.filter(decoded, lambda items: items.isNotNull()))
    return F.when(F.size(solutions) > 0, F.array_join(solutions, SOLUTIONS_JOINT))


def combined(description: Column, solution: Column, separator: str | None) -> Column:
    """Description, separator and solution; without a separator, or with one part
    missing, the solution alone or else the description. Empty parts are missing."""
    description = F.nullif(description, F.lit(""))
    solution = F.nullif(solution, F.lit(""))
    if not separator:
        return F.coalesce(solution, description)
    return F.coalesce(F.concat(description, F.lit(separator), solution), solution, description)


def content_of(schema: StructType, source: Source) -> Column:
    """Snippet text of a source row; null when the row has none."""
    nothing = F.lit(None).cast("string")
    if source.shape == TAGGED_SOLUTIONS:
        texts = tuple(f for f in source.content_fields if _is_text(_type_of(schema, f)))
        solution = first_tagged_solution(schema, source)
        whole = combined(first_text(schema, texts), solution, source.separator)
        return F.when(solution.isNotNull(), whole)
    if source.shape == SOLUTION_LISTS:
        texts = tuple(f for f in source.content_fields if _is_text(_type_of(schema, f)))
        solution = joined_solution_lists(schema, source.solutions_field)
        return combined(first_text(schema, texts), solution, source.separator)
    if source.combine == "concat":
        return all_texts(schema, source.content_fields, source.separator)
    return combined(first_text(schema, source.content_fields), nothing, source.separator)


def record_id(schema: StructType, source: Source) -> Column:
    """First id that the row carries, else the source and the 1-based position."""
    carried = [F.col(f).cast("string") for f in ID_FIELDS if f in schema.fieldNames()]
    counted = F.concat(F.lit(f"{source.id}_"), (F.col("ord") + 1).cast("string"))
    return F.coalesce(*carried, counted)


def records_of(rows: DataFrame, source: Source) -> DataFrame:
    """Uniform records of all source rows; ``rows`` carry their position as ``ord``.

    Rows without usable content are still there, with null content, so that
    yields can be counted; :func:`long_enough` drops them.
    """
    schema = rows.schema
    return rows.select(
        record_id(schema, source).alias("original_id"),
        F.lit(source.id).alias("source_config_id"),
        F.lit(source.hf_name).alias("source_hf_name"),
        F.lit(source.language).alias("language"),
        content_of(schema, source).alias("raw_content"),
        F.col("ord").cast("bigint").alias("ord"),
    )


def is_long_enough(content: Column, minimum: int = MIN_CONTENT_LENGTH) -> Column:
    """Whether there is content of at least ``minimum`` characters; never null."""
    return F.coalesce(F.length(content) >= max(minimum, 1), F.lit(False))


def long_enough(records: DataFrame, minimum: int = MIN_CONTENT_LENGTH) -> DataFrame:
    """Records whose content is not shorter than the minimum."""
    return records.where(is_long_enough(F.col("raw_content"), minimum))
