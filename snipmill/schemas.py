"""Schemas at the stage boundaries."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

TEXT = StringType()
COUNT = IntegerType()
FLAG = BooleanType()
TEXTS = ArrayType(TEXT)


def struct(**fields: DataType) -> StructType:
    """Struct type with nullable fields in the given order."""
    schema = StructType()
    for name, data_type in fields.items():
        schema.add(name, data_type)
    return schema


# One uniform row per snippet. ``ord`` is the position in its source.
RECORD = struct(
    original_id=TEXT,
    source_config_id=TEXT,
    source_hf_name=TEXT,
    language=TEXT,
    raw_content=TEXT,
    ord=LongType(),
)

# All metrics of all languages; a metric is null where its language has none.
CHARACTERISTICS = struct(
    loc=COUNT,
    avg_line_length=DoubleType(),
    num_functions=COUNT,
    num_classes=COUNT,
    imports=TEXTS,
    ast_parse_success=FLAG,
    syntax_error_detail=TEXT,
    num_comments=COUNT,
    includes=COUNT,
    main_function=FLAG,
    function_defs=COUNT,
    num_comments_sl=COUNT,
    num_comments_ml_lines=COUNT,
    num_imports=COUNT,
    class_defs=COUNT,
    main_method=FLAG,
    uses=COUNT,
    fn_defs=COUNT,
    struct_defs=COUNT,
    impl_blocks=COUNT,
)

POOL = StructType(
    [*RECORD.fields, *struct(snippet_id=TEXT, characteristics=CHARACTERISTICS).fields]
)

# What the Python syntax tree tells about a text.
SYNTAX_FACTS = struct(
    parsed=FLAG, error=TEXT, functions=COUNT, classes=COUNT, imports=TEXTS
)

# Lines of the plain corpus form: one JSON object with a text per line.
PLAIN = struct(text=TEXT)
