import random

import pytest
from compare import TABLES, difference

import __spark_entry__ as registered
import corpus_pipeline
from snipmill.llm import stages
from snipmill.llm.oracle import ORACLE
from snipmill.llm.queries import REGISTERED

SF = "/root/testdata/sf0.001"


def prose(seed, n=120):
    draw = random.Random(seed)
    words = ["".join(draw.choice("etaoinshrdlucmfw") for _ in range(draw.randrange(2, 9))) for _ in range(n)]
    return " ".join(words)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Clean documents, and some that each stage has to reject."""
    root = str(tmp_path_factory.mktemp("tables"))
    benchmark = prose("item", 40)
    rows = [(i, prose(i)) for i in range(200)]
    toxic = list(range(200, 300))
    rows += [(i, prose(i) + " you utter blorgface") for i in toxic]
    junk, copies, leaks = 300, range(301, 306), 306
    rows += [(junk, "again and again " * 100)]
    rows += [(i, prose("base") + f" end{i}") for i in copies]
    rows += [(leaks, prose("a", 80) + " " + benchmark + " " + prose("b", 80))]
    rows += [(307, None), (308, ""), (309, "short"), (5, prose(5)), (None, prose("no id"))]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    spark.createDataFrame(full, schema).write.parquet(f"{root}/documents.parquet")
    labels = [(i, int(i in toxic)) for i, _ in rows if i is not None and i < 290]
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, benchmark)], "item_id bigint, text string").write.parquet(
        f"{root}/benchmark.parquet"
    )
    return root


def test_each_stage_rejects_what_it_should(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    ids = lambda df: sorted(r.doc_id if r.doc_id is not None else -1 for r in df.collect())
    wanted = ids(docs)

    def without(*gone):
        return [i for i in wanted if i not in gone]

    for stage, gone in (
        (stages.drop_toxic, range(200, 300)),
        (stages.drop_low_quality, (300, 307, 308, 309)),
        (stages.drop_near_duplicates, range(302, 306)),
        (stages.drop_contaminated, (306,)),
    ):
        found = stage(spark, docs, tables)
        assert found.columns == docs.columns
        wanted = without(*gone)
        if stage is stages.drop_near_duplicates:
            wanted = sorted(set(wanted))  # repeated rows leave one
        assert ids(found) == wanted
        docs = spark.createDataFrame(found.collect(), docs.schema)
    last = stages.encode(spark, docs, tables)
    assert ids(last) == wanted and all(r.n_tokens == len(r.ids) > 0 for r in last.collect())


def test_every_text_is_judged_by_itself(spark, documents, tmp_path):
    """Texts that share an id, or have none, are no copies of each other."""
    item = prose("leak", 30)
    rows = [(1, prose("a")), (1, prose("b")), (None, prose("c")), (None, prose("c") + " end"),
            (2, prose("d")), (9, prose("d") + " end"), (3, prose("e")), (3, prose("e"))]
    kept = stages.drop_near_duplicates(spark, documents(rows), "").collect()
    texts = [(r.doc_id, r.text.split()[0]) for r in kept]
    first = {k: prose(k).split()[0] for k in "abcde"}
    assert sorted(texts, key=repr) == sorted(
        [(1, first["a"]), (1, first["b"]), (None, first["c"]), (2, first["d"]), (3, first["e"])], key=repr
    )
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, item), (1, item), (1, prose("a")), (None, prose("b"))]
    kept = stages.drop_contaminated(spark, documents(rows), str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(1, prose("a")), (0, prose("b"))])


def test_run_equals_the_stages(spark, tables):
    found = corpus_pipeline.run(spark, tables)
    ids = [r.doc_id for r in found.collect()]
    assert sorted(i for i in ids if i is not None) == [*range(200), 301] and ids.count(None) == 1


def test_empty_tables_pass_through(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, tables).count() == 0


def test_registered():
    names = registered.queries()
    assert set(REGISTERED) | {"pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTERED) == list(range(1, 14))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and "documents" in TABLES


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_its_twin(spark, name):
    assert difference(spark, name, SF) is None


@pytest.mark.parametrize("name", ["op1_", "op2_", "op4_", "op5_", "op6_", "op8_", "op9_", "op10_", "op11_", "op12_", "op13_"])
def test_query_has_a_row_per_row(spark, name):
    (query,) = (q for n, q in REGISTERED.items() if n.startswith(name))
    found = query(spark, SF)
    key = "page_id" if "page_id" in found.columns else "doc_id"
    table = "pages" if key == "page_id" else "documents"
    ids = spark.read.parquet(f"{SF}/{table}.parquet").select(key)
    assert found.select(key).distinct().count() == ids.distinct().count()
    if name != "op9_":
        assert found.count() == ids.count()
