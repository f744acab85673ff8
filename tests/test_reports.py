"""Reports and the survivor of duplicates."""

from pyspark.sql import functions as F

from snipmill.operators import dedup
from snipmill.operators.dedup import keep_first
from snipmill.operators.extract import is_long_enough
from snipmill.operators.reports import dedup_report, language_distribution, yield_report, zero_yield
from snipmill.schemas import RECORD


def records(spark, rows):
    return spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], RECORD)


ROWS = [
    ("b", "h", "python", "same", 1),
    ("a", "h", "python", "same", 7),
    ("a", "h", "python", "same", 3),
    ("z", "h", "cpp", "same", 9),
    ("a", "h", None, "other", 0),
    ("a", "h", "cpp", "", 0),
    ("a", "h", "cpp", None, 0),
]


def test_survivor_is_first_by_language_source_and_position(spark):
    found = keep_first(records(spark, ROWS)).collect()
    assert {(r.original_id, r.raw_content) for r in found} == {("3", "same"), ("4", "other")}
    same_language = keep_first(records(spark, ROWS[:3])).collect()
    assert [r.original_id for r in same_language] == ["2"]


def test_dedup_is_idempotent(spark):
    once = keep_first(records(spark, ROWS)).select(*RECORD.names)
    assert keep_first(once).select(*RECORD.names).exceptAll(once).isEmpty()


def test_dedup_report(spark):
    assert dedup_report(records(spark, ROWS)).head().asDict() == {
        "loaded": 7, "unique_records": 2, "removed_empty": 2, "removed": 5,
        "removed_duplicates": 3,
    }
    empty = dedup_report(spark.createDataFrame([], RECORD)).head()
    assert (empty.loaded, empty.unique_records, empty.removed) == (0, 0, 0)


def test_yields(spark):
    kept = is_long_enough(F.col("raw_content"), 5)
    report = yield_report(records(spark, ROWS), kept)
    assert {tuple(r) for r in report.collect()} == {
        ("a", 5, 1, 0), ("b", 1, 0, 0), ("z", 1, 0, 0), (None, 7, 1, 1),
    }
    assert {r.source_config_id for r in zero_yield(report).collect()} == {"b", "z"}


def test_language_distribution(spark):
    found = {tuple(r) for r in language_distribution(records(spark, ROWS)).collect()}
    assert found == {("python", 3), ("cpp", 3), ("unknown", 1)}


def test_hot_contents_are_split(spark, monkeypatch):
    """A content that is in every file reaches the last task once per salt only."""
    monkeypatch.setattr(dedup, "HOT_COPIES", 200)
    monkeypatch.setattr(dedup, "SALTS", 4)
    kinds = {0: "hot", 1: "hot", 2: "warm"}
    rows = [(f"s{i % 7}", "h", "c", kinds.get(i % 5, f"text {i // 3}"), i) for i in range(2_000)]
    df = records(spark, rows).repartition(50)
    found = keep_first(df).collect()
    wanted = {}
    for i, (source, _, language, content, ord_) in enumerate(rows):
        own = ((language, source, ord_), str(i))
        wanted[content] = min(wanted.get(content, own), own)
    assert {(r.raw_content, r.original_id) for r in found} == {(c, w[1]) for c, w in wanted.items()}
    assert len(found) == len(wanted)
    assert dedup.hot_contents(dedup.drop_empty(df).withColumn("snippet_id", F.col("raw_content"))).count() == 2
    assert "_salt" in keep_first(df)._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.undo()
    assert "_salt" not in keep_first(df)._jdf.queryExecution().optimizedPlan().toString()


def test_hot_copies_meet_in_groups_first(spark, monkeypatch):
    monkeypatch.setattr(dedup, "HOT_COPIES", 100)
    monkeypatch.setattr(dedup, "SALTS", 4)
    inputs = []
    own = dedup._first
    monkeypatch.setattr(dedup, "_first", lambda rows, keys, order: inputs.append(rows) or own(rows, keys, order))
    rows = [("s", "h", "c", "hot" if i % 2 else f"text {i}", i) for i in range(1_000)]
    keep_first(records(spark, rows).repartition(40))
    copies = inputs[-1].where("raw_content = 'hot'").count()
    assert 1 < copies <= 4 and inputs[-1].where("raw_content <> 'hot'").count() == 500
