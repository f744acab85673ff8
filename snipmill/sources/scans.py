"""Batch scans of sources: positions, caps and the schema contract."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import ArrayType, NullType, StringType, StructType

from snipmill.session import materialise
from snipmill.sources.files import can_open, opened
from snipmill.sources.registry import TAGGED_SOLUTIONS, Source

_FILE, _START, _ROW, _BEFORE = "_file", "_start", "_row", "_before"


def missing_paths(schema: StructType, source: Source) -> list[str]:
    """What a source must have and its schema lacks; empty when it is fine.

    The schema speaks for all rows, and no job runs to find out.
    """
    names = schema.fieldNames()
    missing = [f for f in source.content_fields if f not in names]
    if source.shape != TAGGED_SOLUTIONS:
        return missing
    field = source.solutions_field
    if field not in names:
        return [*missing, field]
    data_type = schema[field].dataType
    if not isinstance(data_type, ArrayType) or not isinstance(data_type.elementType, StructType):
        return [*missing, f"{field}: not a list of structs"]
    entry = data_type.elementType
    for key in (source.language_key, source.code_key):
        if key not in entry.fieldNames():
            missing.append(f"{field}.{key}")
    for key, lists in ((source.language_key, True), (source.code_key, False)):
        if key in entry.fieldNames():
            kind = entry[key].dataType
            labels = lists and isinstance(kind, ArrayType)
            if not isinstance(kind.elementType if labels else kind, StringType):
                missing.append(f"{field}.{key}: not text")
    return missing


def _with_rows_before(rows: DataFrame, first: int | None) -> DataFrame:
    """Add the number of rows in all files before the file of a row.

    The sum runs over one row per file. Those are written first, so Spark knows
    their true size when it picks the join. Files that begin behind the first
    ``first`` rows are left out.
    """
    before = Window.orderBy(_FILE).rowsBetween(Window.unboundedPreceding, -1)
    files = materialise(
        rows.groupBy(_FILE)
        .agg(F.count("*").alias("_rows"))
        .select(_FILE, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias(_BEFORE)),
        "files",
    )
    if first is not None:
        files = files.where(F.col(_BEFORE) < first)
    return rows.join(files, _FILE)


def parquet_positions(rows: DataFrame, first: int | None = None) -> DataFrame:
    """Add ``ord``, by file name and row index, to the first rows of Parquet files."""
    placed = rows.withColumns(
        {_FILE: F.col("_metadata.file_path"), _ROW: F.col("_metadata.row_index")}
    )
    numbered = _with_rows_before(placed, first).withColumn("ord", F.col(_BEFORE) + F.col(_ROW))
    kept = numbered if first is None else numbered.where(F.col("ord") < first)
    return kept.drop(_FILE, _ROW, _BEFORE)


def line_place() -> dict[str, Column]:
    """Columns that sort the rows of text files by file, then by line.

    A scan task reads its file slices one after the other and the increasing id
    grows with them, so inside one slice (file and start) it follows the lines.
    """
    return {
        _FILE: F.col("_metadata.file_path"),
        _START: F.col("_metadata.file_block_start"),
        _ROW: F.monotonically_increasing_id(),
    }


def _slice_shifts(placed: DataFrame, column: str) -> DataFrame:
    """Per slice of a file, by a hash of its name and start: ``_shift``, which makes the id
    of a row its place among all rows, and the ids between which its rows lie.

    One narrow row per slice, which is some hundred MB of text: 100 TB have a million.
    """
    # Counts a column, as lines without an object are no rows once something is read.
    first, last = F.min(_ROW).alias("_first"), F.max(_ROW).alias("_last")
    n = F.count_if(F.col(column).isNull() | F.col(column).isNotNull()).alias("_rows")
    before = Window.orderBy(_FILE, _START).rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")
    slices = placed.groupBy(_FILE, _START).agg(first, last, n)
    found = slices.select(_slice(), shift.alias("_shift"), "_first", "_last")
    shifts = materialise(found, "slices")
    if shifts.groupBy(_SLICE).count().where("count > 1").count():
        raise ValueError("two slices of files share a hash")
    return shifts


_SLICE = "_slice"


def _slice() -> Column:
    return F.xxhash64(_FILE, _START).alias(_SLICE)


def line_positions(rows: DataFrame, first: int | None = None) -> DataFrame:
    """Add ``ord``, by file name and line, to the (first) rows of JSON files.

    Text files have no row index. Lines are counted per slice of a file; the sum of the
    slices before, and the place in the own one, make the position. Only the sums are
    moved, to every task; lines stay in the task that reads them. If a row does not lie
    in a slice as it was counted, the job fails.
    """
    placed = rows.withColumns(line_place())
    shifts = _slice_shifts(placed, rows.columns[0])
    found = placed.withColumn(_SLICE, _slice()).join(F.broadcast(shifts), _SLICE, "left")
    known = F.coalesce(F.col(_ROW).between(F.col("_first"), F.col("_last")), F.lit(False))
    place = F.when(known, F.col(_ROW) + F.col("_shift")).otherwise(
        F.raise_error(F.lit("input changed while its lines were numbered"))
    )
    numbered = found.withColumn("ord", place.cast("bigint")).select(*rows.columns, "ord")
    return numbered if first is None else numbered.where(F.col("ord") < first)


FIRST_FILES = 8  # files that are counted first for a capped source; then twice as many


def _reader(spark: SparkSession, source: Source) -> DataFrameReader:
    reader = spark.read.format(source.format)
    return reader.schema(source.schema) if source.schema else reader


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Files below a path by name; names come to the driver, as whenever Spark lists them."""
    names = F.col("_metadata.file_path").alias("name")
    listed = spark.read.format("binaryFile").load(path).select("path", names).collect()
    return [r.path for r in sorted(listed, key=lambda r: r.name)]


def _footer_schemas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Schema of each Parquet file, as Spark writes it down; types that Spark has no
    name for are nulls."""
    for batch in batches:
        names = batch["path"].to_pylist()
        schemas = []
        for name in names:
            with opened(name) as file:
                fields = StructType()
                for field in pq.read_schema(file):
                    try:
                        kind = from_arrow_type(field.type)
                    except PySparkException:
                        kind = NullType()
                    fields = fields.add(field.name, kind)
            schemas.append(fields.json())
        yield pa.RecordBatch.from_pydict({"path": names, "schema": schemas})


def files_by_contract(
    spark: SparkSession, source: Source, root: str
) -> tuple[dict[str, list[str]], list[str]]:
    """Files of a Parquet source that lack a field, by the fields they lack, and the others.

    Spark takes the schema of one file for all. Here the tasks read the footer of each;
    the driver gets every schema once, and names of files only if one of them is odd.
    Stores that pyarrow does not open are not looked through.
    """
    path = source.path(root)
    if source.format != "parquet" or not can_open(path):
        return {}, []
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    footers = materialise(
        files.select("path").mapInArrow(_footer_schemas, "path string, schema string"), "footers"
    )
    lacking = {}
    for row in footers.select("schema").distinct().collect():
        missing = missing_paths(StructType.fromJson(json.loads(row.schema)), source)
        if missing:
            lacking[row.schema] = ", ".join(missing)
    if not lacking:
        return {}, []
    odd: dict[str, list[str]] = {}
    good = []
    for row in footers.orderBy("path").collect():
        if row.schema in lacking:
            odd.setdefault(lacking[row.schema], []).append(row.path)
        else:
            good.append(row.path)
    return odd, good


def leading_files(
    spark: SparkSession, source: Source, root: str, files: Sequence[str] | None = None
) -> list[str]:
    """The files of a capped source, by name, that hold its first rows.

    Names come to the driver, as they do whenever Spark lists files, and counts of
    growing groups of files, until there are enough rows.
    """
    files = file_names(spark, source.path(root)) if files is None else files
    at, rows, group = 0, 0, FIRST_FILES
    while at < len(files) and rows < source.max_samples:
        rows += _reader(spark, source).load(files[at : at + group]).count()
        at, group = at + group, 2 * group
    return list(files[:at])


def _without_scheme(path: str) -> str:
    return re.sub("^[a-z][a-z0-9]*:/+", "/", path)


def open_source(
    spark: SparkSession, source: Source, root: str, only: Sequence[str] | None = None
) -> DataFrame:
    """Rows of a source, found by name, subset and split: all of them, or those of the
    files that hold the first ``max_samples``; of certain files only, if they are given."""
    path = source.path(root)
    files = leading_files(spark, source, root, only) if source.max_samples else list(only or [])
    reader = _reader(spark, source)
    if not files or _without_scheme(files[0]) == _without_scheme(path):
        return reader.load(path)
    return reader.option("basePath", path).load(files)


def with_positions(rows: DataFrame, source: Source) -> DataFrame:
    """Add ``ord``; of a capped source, keep only the first ``max_samples`` rows,
    before any other filter."""
    number = parquet_positions if source.format == "parquet" else line_positions
    return number(rows, source.max_samples)


def scan(spark: SparkSession, source: Source, root: str) -> DataFrame:
    """Rows of a source with their ``ord``, up to its cap."""
    return with_positions(open_source(spark, source, root), source)


def is_missing(error: Exception) -> bool:
    """Whether an error says that a path does not exist."""
    return isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND"
