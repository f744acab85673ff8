"""Extraction: one hand-written row per rule."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from snipmill.operators.extract import (
    combined,
    long_enough,
    normalised_label,
    record_id,
    records_of,
)
from snipmill.sources.registry import (
    SOLUTION_LISTS,
    SOURCES,
    TAGGED_SOLUTIONS,
    Source,
    plain_corpus,
)
from snipmill.sources.scans import missing_paths

FLAT = Source("s", "data/s", "python", "train", ("a", "b"), "|")


def contents(spark, source, rows, schema):
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"{schema}, ord bigint")
    return [r.raw_content for r in records_of(frame, source).orderBy("ord").collect()]


def test_first_visible_text_wins_and_the_other_is_left_out(spark):
    rows = [(" x \n", "y"), (" \n", "y "), (None, "y"), ("", None)]
    assert contents(spark, FLAT, rows, "a string, b string") == ["x", "y", "y", None]


def test_concat_option_joins_all_fields(spark):
    source = replace(FLAT, combine="concat")
    rows = [(" x ", "y"), (" ", "y"), (None, None)]
    assert contents(spark, source, rows, "a string, b string") == ["x|y", "y", None]


def test_text_beats_an_earlier_list(spark):
    rows = [(["l"], "t"), ([" l ", "", "m"], " "), ([], "")]
    assert contents(spark, FLAT, rows, "a array<string>, b string") == ["t", "l\nm", None]


def test_first_present_list_counts_even_when_empty(spark):
    rows = [([], ["x"]), (["", " "], ["x"]), (None, ["x"]), (["a", None], ["x"])]
    found = contents(spark, FLAT, rows, "a array<string>, b array<string>")
    assert found == [None, None, "x", "x"]


def test_labels(column):
    cases = {
        "Python3": "python", "C++ 17": "cpp", "GNU C++": "cpp", "Java 13": "java1",
        "C": "c", "PYTHON": "python", "3": "", None: None,
    }
    found = column([(c,) for c in cases], "l string", normalised_label(F.col("l")))
    assert found == list(cases.values())


TAGGED = Source(
    "t", "data/t", "cpp", "train", ("description",), "|", shape=TAGGED_SOLUTIONS
)


def test_first_tagged_solution(spark):
    schema = "description string, solutions array<struct<language: string, solution: string>>"
    rows = [
        (" d ", [("Python3", "p"), ("C++", " "), ("C++ 11", " one "), ("C++", "two")]),
        ("", [("c++", "one")]),
        ("d", [("Java", "j"), (None, "x")]),
        ("d", []),
        ("d", None),
    ]
    assert contents(spark, TAGGED, rows, schema) == ["d|one", "one", None, None, None]
    java = replace(TAGGED, language="java")
    rows = [("d", [("Java 13", "x")]), ("d", [("Java", "x")])]
    assert contents(spark, java, rows, schema) == [None, "d|x"]


def test_tagged_solution_with_several_labels(spark):
    schema = (
        "description string, solutions array<struct<language: array<string>, solution: string>>"
    )
    rows = [("d", [(["Java"], "j"), (["C", None, "G++ c++"], "one")]), ("d", [([], "x")])]
    assert contents(spark, TAGGED, rows, schema) == ["d|one", None]


def test_without_separator_the_description_is_dropped(spark):
    schema = "description string, solutions array<struct<language: string, solution: string>>"
    source = replace(TAGGED, separator=None)
    assert contents(spark, source, [("d", [("C++", "s")])], schema) == ["s"]


LISTED = Source(
    "apps", "data/l", "python", "train", ("problem", "solutions"), "|", shape=SOLUTION_LISTS
)


def test_solution_lists_in_json(spark):
    rows = [
        (" p ", ['["a", 1, " b "]', "junk", '{"c": "d"}', '["", "e"]']),
        ("", ['["a"]']),
        ("p", ["[]", "['x']"]),
        ("p", None),
        (" ", []),
        (None, [None, '["a"]']),
    ]
    joint = "\n\n---\n\n"
    assert contents(spark, LISTED, rows, "problem string, solutions array<string>") == [
        "p|" + joint.join(["a", " b ", "", "e"]), "a", "p", "p", None, "a",
    ]


def test_solution_lists_already_decoded(spark):
    rows = [("p", [["a", None], None, ["b"]]), ("p", [])]
    found = contents(spark, LISTED, rows, "problem string, solutions array<array<string>>")
    assert found == ["p|a\n\n---\n\nb", "p"]


def test_plain_solutions_are_never_decoded(spark):
    rows = [("p", '["a"]'), (" ", ' ["a"] ')]
    assert contents(spark, LISTED, rows, "problem string, solutions string") == ["p", '["a"]']


def test_combined(column):
    rows = [("d", "s"), ("d", ""), (None, "s"), ("", None)]
    d, s = F.col("d"), F.col("s")
    assert column(rows, "d string, s string", combined(d, s, "|"), combined(d, s, "")) == [
        ("d|s", "s"), ("d", "d"), ("s", "s"), (None, None),
    ]


def test_length_counts_characters(spark):
    frame = spark.createDataFrame(
        [("a" * 19,), ("a" * 20,), ("\U0001f600" * 20,), ("",), (None,)], "raw_content string"
    )
    assert sorted(len(r[0]) for r in long_enough(frame).collect()) == [20, 20]
    assert long_enough(frame, 0).count() == 3


def test_ids(spark):
    frame = spark.createDataFrame(
        [(7, "n", "p", 0), (None, "n", "p", 1), (None, None, "p", 2), (None, None, None, 3)],
        "id bigint, name string, problem_id string, ord bigint",
    )
    found = frame.select(record_id(frame.schema, FLAT).alias("i")).collect()
    assert [r.i for r in found] == ["7", "n", "p", "s_4"]
    bare = frame.select("ord")
    assert bare.select(record_id(bare.schema, FLAT).alias("i")).head().i == "s_1"


def test_record_columns(spark):
    frame = spark.createDataFrame([("x" * 30, 5)], "a string, ord bigint")
    (row,) = records_of(frame, replace(FLAT, content_fields=("a",))).collect()
    assert row.asDict() == {
        "original_id": "s_6", "source_config_id": "s", "source_hf_name": "data/s",
        "language": "python", "raw_content": "x" * 30, "ord": 5,
    }


@pytest.mark.parametrize(
    "schema, source, missing",
    [
        ("a string, b string", FLAT, []),
        ("a string", FLAT, ["b"]),
        ("description string", TAGGED, ["solutions"]),
        ("description string, solutions array<string>", TAGGED,
         ["solutions: not a list of structs"]),
        ("description string, solutions array<struct<language: string>>", TAGGED,
         ["solutions.solution"]),
        ("solutions array<struct<language: int, solution: string>>", TAGGED,
         ["description", "solutions.language: not text"]),
        ("description string, solutions array<struct<language: array<string>, "
         "solution: string>>", TAGGED, []),
        ("description string, solutions struct<language: array<int>, "
         "solution: array<string>>", TAGGED, ["solutions: not a list of structs"]),
        ("problem string", LISTED, ["solutions"]),
    ],
)
def test_schema_contract(spark, schema, source, missing):
    assert missing_paths(spark.createDataFrame([], schema).schema, source) == missing


def test_registry():
    assert len(SOURCES) == len({s.id for s in SOURCES}) == 9
    assert [s.language for s in SOURCES].count("python") == 5
    assert sum(s.max_samples for s in SOURCES) == 115_050
    assert SOURCES[0].path("/d/") == "/d/mbpp/train"
    assert replace(SOURCES[0], subset="full").path("/d") == "/d/mbpp/full/train"
    assert replace(SOURCES[0], stream=True).streamed
    assert not replace(SOURCES[5], stream=True).streamed
    assert plain_corpus("x", "go").content_fields == ("text",)
