"""Registered queries: against their SQL twins, and by the shape of their plans."""

import pytest
from compare import difference

import __spark_entry__ as registered
from snipmill.catalog.oracle import ORACLE
from snipmill.catalog.queries import REGISTERED
from snipmill.sources.jsonl import read_pool

SF = "/root/testdata/sf0.001"


def test_every_query_has_a_twin():
    assert set(REGISTERED) == set(ORACLE)
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry_has_rows(spark):
    found = registered.entry(spark)
    assert found.columns == ["language", "n", "sum_loc", "mean_line_length"]
    assert found.count() == 4


@pytest.mark.parametrize("name", list(REGISTERED))
def test_query_equals_its_twin(spark, name):
    assert difference(spark, name, SF) is None


def plan_of(spark, name):
    df = registered.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_read_columns_reach_the_scan(spark):
    plan = plan_of(spark, "first_n_per_source")
    assert "FileScan parquet" in plan and "text" not in plan
    assert "html" not in plan_of(spark, "pool_summary")


def test_copies_are_dropped_before_the_shuffle(spark):
    plan = plan_of(spark, "exact_dedup_keep_first")
    final, partial = plan.index("row_number(), 1, Final"), plan.index("row_number(), 1, Partial")
    assert final < plan.index("Exchange hashpartitioning(snippet_id") < partial
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize(
    "name", ["exclude_used", "selection_contents", "train_val_split", "sample_any"]
)
def test_no_pairs_of_all_rows(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_text_is_split_once(spark):
    plan = plan_of(spark, "char_c_cpp")
    assert plan.count("AS _pieces") == 1
    assert "ArrowEvalPython" not in plan


def test_only_wanted_metrics_are_planned(spark):
    plan = plan_of(spark, "pool_summary")
    assert "ArrowEvalPython" not in plan and "num_comments" not in plan


def test_a_pool_line_is_parsed_once(spark, tmp_path):
    (tmp_path / "pool.jsonl").write_text('{"language": "c", "characteristics": {"loc": 1}}\n')
    pool, _ = read_pool(spark, f"{tmp_path}/pool.jsonl")
    plan = pool._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= 2
    assert pool.head().characteristics.loc == 1


def test_known_sources_sort_documents_once(spark, tmp_path, monkeypatch):
    """All layouts come from one sort, and are in the order of the ids."""
    texts = {i: f"text number {i} of some documents, not in their order" for i in range(120)}
    rows = [(i, texts[i], "s") for i in sorted(texts, key=lambda i: i * 37 % 120)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    documents.repartition(6).write.parquet(f"{tmp_path}/documents.parquet")
    sorts, order_by = [], type(documents).orderBy
    monkeypatch.setattr(
        type(documents), "orderBy", lambda df, *c, **k: sorts.append(c) or order_by(df, *c, **k)
    )
    found = REGISTERED["known_sources"](spark, str(tmp_path)).collect()
    assert sorts == [("doc_id",)]
    ids = lambda source: sorted(int(r.original_id) for r in found if r.source == source)
    assert ids("apps_py") == list(range(50))
    assert ids("mbpp_py") == list(range(120))
    assert ids("cpp_code_contests") == list(range(0, 120, 2))
    assert ids("rust_code_snippets_new") == [i for i in range(120) if i % 3]
    assert {r.n_not_done for r in found} == {0}
