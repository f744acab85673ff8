"""Inputs of the registered queries, derived row by row from the given tables.

Shapes that the tables do not have (lists, nested and JSON-encoded solutions,
token ids, predictions) are built from the whole text of a row, never by
gathering rows. Each has a twin in :mod:`snipmill.catalog.oracle`.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snipmill.catalog import templates
from snipmill.functions.text import strip
from snipmill.operators.sequences import with_sequences
from snipmill.sources.registry import SOLUTION_LISTS, TAGGED_SOLUTIONS, Source

VOCABULARY = 50_000
PAD, EOS = 0, VOCABULARY + 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records: language and source as they are, stripped text."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("original_id"),
        F.col("source").alias("source_config_id"),
        F.lit("documents").alias("source_hf_name"),
        F.col("lang").alias("language"),
        strip(F.col("text")).alias("raw_content"),
        F.col("doc_id").alias("ord"),
    )


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as records of a language without metrics of its own."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("original_id"),
        F.lit("pages").alias("source_config_id"),
        F.col("url").alias("source_hf_name"),
        F.lit("html").alias("language"),
        F.col("html").alias("raw_content"),
        F.col("page_id").alias("ord"),
    )


def snippet_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as source code in six languages."""
    return table(spark, sf_dir, "part").select(
        *(F.expr(text).alias(name) for name, text in templates.RECORD_COLUMNS.items())
    )


def two_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with two text fields, the first of them sometimes blank."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS id",
        "CASE WHEN n_chars % 3 = 0 THEN concat(' ', chr(9), chr(10)) "
        "ELSE concat(chr(10), text, '  ') END AS prompt",
        "concat(text, chr(10), source) AS answer",
        "doc_id AS ord",
    )


def list_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a mostly blank text and two lists, the first of them
    sometimes empty or with a null in it."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.expr("CASE WHEN n_chars % 4 = 0 THEN concat(source, ' ') ELSE ' ' END").alias("title"),
        F.when(F.expr("n_chars % 7 = 0"), F.array().cast("array<string>"))
        .when(
            F.expr("n_chars % 5 = 0"),
            F.concat(F.split("text", "\n"), F.array(F.lit(None).cast("string"))),
        )
        .otherwise(F.split("text", "\n"))
        .alias("parts"),
        F.array("source", F.lit("  "), "text").alias("rest"),
        F.col("doc_id").alias("ord"),
    )


# Labels of solutions, in the order in which they are dealt out.
LABELS = ("C++ 17", "Python3", "Java 13", "GNU c++", "C", "PyPy 3")


def _dealt(index: str, labels: tuple[str, ...] = LABELS) -> str:
    cases = " ".join(f"WHEN {i} THEN '{label}'" for i, label in enumerate(labels))
    return f"CASE ({index}) % {len(labels)} {cases} END"


def labelled_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations with one label or a pair of labels each."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", f"{_dealt('conv_id + turn')} AS label", "text"
    )


def tagged_solutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns whose lines are solutions, with a label each; labels of the system
    role never match a language."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "concat(conv_id, '-', turn) AS name",
        "role AS description",
        "transform(split(text, '\n'), (line, i) -> named_struct("
        "'language', CASE WHEN role = 'system' THEN 'Java 13' "
        f"ELSE {_dealt('conv_id + turn + i')} END, 'solution', line)) AS solutions",
        "conv_id AS ord",
    )


def listed_solutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns whose lines are a JSON list: whole, cut off, with other items, or
    an object; a second item is always a whole list."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "concat(conv_id, '-', turn) AS name",
        "CASE WHEN turn % 2 = 0 THEN concat(' ', role) ELSE '' END AS problem",
        "array(CASE conv_id % 7 "
        "WHEN 0 THEN substr(to_json(split(text, '\n')), 2) "
        "WHEN 1 THEN concat('[1,null,', substr(to_json(split(text, '\n')), 2)) "
        "WHEN 2 THEN to_json(named_struct('lines', split(text, '\n'))) "
        "WHEN 3 THEN concat(to_json(split(text, '\n')), ' junk') "
        "ELSE to_json(split(text, '\n')) END, "
        "CASE WHEN conv_id % 3 = 0 THEN '[\"\", \" tail \"]' ELSE '[]' END) AS solutions",
        "conv_id AS ord",
    )


def laid_out(documents: DataFrame, source: Source) -> DataFrame:
    """Documents in their order, in the shape of a known source: the first text of every
    third is blank where there are no solutions, every second solution is in Java, the
    others in C++."""
    code = F.concat_ws(" ", "source", "text")
    first, *others = source.content_fields
    if source.shape == TAGGED_SOLUTIONS:
        label = F.when(F.col("doc_id") % 2 == 0, "C++ 17").otherwise("Java")
        entry = F.struct(label.alias(source.language_key), code.alias(source.code_key))
        fields = [F.col("text").alias(first), F.array(entry).alias(source.solutions_field)]
    elif source.shape == SOLUTION_LISTS:
        items = F.to_json(F.array(F.col("source"), code))
        fields = [F.col("text").alias(first), F.array(items).alias(source.solutions_field)]
    else:
        blank = F.when(F.col("doc_id") % 3 == 0, " ").otherwise(F.col("text"))
        fields = [blank.alias(first), *(code.alias(name) for name in others)]
    return documents.select(F.col("doc_id").alias("id"), *fields)


def parts_to_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with a description, a solution, both or neither."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id",
        "turn",
        "CASE conv_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE role END AS description",
        "CASE turn % 3 WHEN 0 THEN text WHEN 1 THEN '' END AS solution",
    )


def id_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose ids lie in different fields, or nowhere."""
    return table(spark, sf_dir, "documents").selectExpr(
        "CASE WHEN n_chars % 3 = 0 THEN doc_id END AS id",
        "CASE WHEN n_chars % 2 = 0 THEN concat(source, '-', lang) END AS name",
        "text",
        "doc_id AS ord",
    )


def document_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with token ids, made of the length, first and last letter of
    each word. Some have no token, and for some the ids are missing."""
    token = (
        "(length(w) * 1009 + ascii(w) * 31 + ascii(substr(w, -1))) "
        f"% {VOCABULARY} + 1"
    )
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "lang",
        "CASE WHEN n_chars % 11 = 0 THEN NULL "
        "WHEN n_chars % 13 = 0 THEN array() "
        f"ELSE transform(split(text, ' '), w -> CAST({token} AS INT)) END AS token_ids",
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch per document: the sequence is the label, and a prediction is
    right in six places out of ten."""
    sequences = with_sequences(document_tokens(spark, sf_dir), PAD, EOS)
    return sequences.selectExpr(
        "lang AS phase",
        "doc_id AS batch_id",
        "CASE WHEN token_ids IS NOT NULL THEN size(token_ids) / 100D END AS loss",
        "input_ids AS label",
        "transform(input_ids, (t, i) -> "
        "CASE WHEN (doc_id + t * 7 + i) % 10 < 6 THEN t ELSE t + 1 END) AS pred",
        "attention_mask AS attention",
    )


# Fixed value: the first bytes of a member of a gzip file.
_MEMBER = b"\x1f\x8b\x08"


def broken_off(spark: SparkSession, source: str, target: str) -> set[tuple[str, int]]:
    """Copies of the gzip files of a folder, each with the begin of a further member, which
    never ends. Returns their names and sizes."""
    def uri(path: str) -> str:
        return re.sub("^(file:)?/+", "file:///", path)

    def copy(batches):
        for batch in batches:
            names = batch["path"].to_pylist()
            sizes = []
            for name in names:
                system, path = fs.FileSystem.from_uri(uri(name))
                to, folder = fs.FileSystem.from_uri(uri(target))
                to.create_dir(folder)
                copied = f"{folder}/{path.rpartition('/')[2]}"
                with system.open_input_stream(path, compression=None) as a:
                    with to.open_output_stream(copied, compression=None) as b:
                        while piece := a.read(1 << 20):
                            b.write(piece)
                        b.write(_MEMBER)
                sizes.append(to.get_file_info(copied).size)
            yield pa.RecordBatch.from_pydict({"name": [n.rpartition("/")[2] for n in names], "size": sizes})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source)
    made = files.select("path").mapInArrow(copy, "name string, size bigint")
    return {tuple(r) for r in made.collect()}
