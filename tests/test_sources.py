"""Scans, JSON Lines and the stages that read and write them."""

import bz2
import gzip
import json
import random
import threading
import zlib
from dataclasses import replace

import pytest
import zstandard
from pyspark.errors import AnalysisException

from snipmill.plans import extraction
from snipmill.plans.extraction import extract_all, yield_totals
from snipmill.plans.pool import build_pool, pool_from_jsonl
from snipmill.schemas import CHARACTERISTICS, POOL, RECORD
from snipmill.session import new_path, shared_folder
from snipmill.operators.reports import dedup_report
from snipmill.sources.jsonl import (
    export_pool,
    read_pool,
    read_records,
    stored_records,
)
from snipmill.sources.readable import split_lines
from snipmill.sources.registry import TAGGED_SOLUTIONS, Source, plain_corpus
from snipmill.sources.scans import open_source, scan
from snipmill.streaming.bounded import take

CODE = Source("src", "data/code", "python", "train", ("code",), max_samples=10_000)


def write_parts(spark, path, parts, write):
    """Several files in a known order."""
    for i, values in enumerate(parts):
        frame = spark.createDataFrame([(v,) for v in values], "code string").coalesce(1)
        write(frame, f"{path}/part={i}")


def test_positions_of_parquet_rows(spark, tmp_path):
    values = [[f"{i}-{j:04}" for j in range(n)] for i, n in enumerate((300, 1, 77))]
    path = f"{tmp_path}/data/code/train"
    write_parts(spark, path, values, lambda f, p: f.write.parquet(p))
    wanted = [v for part in values for v in part]
    for cap in (None, 0, 1, 300, 301, 350, 1000):
        rows = scan(spark, replace(CODE, max_samples=cap), str(tmp_path)).collect()
        assert sorted((r.ord, r.code) for r in rows) == list(enumerate(wanted))[:cap]


@pytest.mark.parametrize("format", ["parquet", "json"])
def test_capped_sources_read_only_the_files_they_need(spark, tmp_path, format):
    values = [[f"{i:02}-{j}" for j in range(5)] for i in range(40)]
    source = replace(CODE, format=format, schema="code string" if format == "json" else None)
    write_parts(spark, source.path(str(tmp_path)), values, lambda f, p: f.write.format(format).save(p))
    for cap, files in ((1, 8), (40, 8), (41, 24), (10_000, 40), (None, 40)):
        rows = open_source(spark, replace(source, max_samples=cap), str(tmp_path))
        assert len(rows.inputFiles()) == files
    rows = scan(spark, replace(source, max_samples=7), str(tmp_path))
    wanted = [v for part in sorted(zip([f"part={i}" for i in range(40)], values)) for v in part[1]]
    assert [r.code for r in sorted(rows.collect(), key=lambda r: r.ord)] == wanted[:7]


def test_positions_of_json_lines_across_slices(spark, tmp_path):
    values = [[f"{i}-{j:05}" for j in range(n)] for i, n in enumerate((4000, 10, 3000))]
    source = replace(CODE, format="json", schema="code string")
    write_parts(spark, f"{tmp_path}/data/code/train", values, lambda f, p: f.write.json(p))
    wanted = list(enumerate(v for part in values for v in part))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        for cap in (None, 1, 3999, 4005, 5500):
            rows = scan(spark, replace(source, max_samples=cap), str(tmp_path)).collect()
            assert sorted((r.ord, r.code) for r in rows) == wanted[:cap]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_stream_takes_exactly_n(spark, tmp_path):
    path = f"{tmp_path}/lines"
    spark.range(1000).selectExpr("CAST(id AS STRING) AS code").repartition(9).write.json(path)
    for n, wanted in ((137, 137), (5000, 1000)):
        rows = take(spark, path, "code string", n, maxFilesPerTrigger="2")
        assert rows.count() == rows.distinct().count() == wanted


def test_streamed_source(spark, tmp_path):
    source = replace(CODE, stream=True, format="json", schema="code string", max_samples=50)
    spark.range(99).selectExpr("concat('this is the code number ', id) AS code").write.json(
        source.path(str(tmp_path))
    )
    (status,) = extract_all(spark, str(tmp_path), f"{tmp_path}/out", [source])
    assert (status.status, status.processed, status.written) == ("done", 50, 50)
    records, _ = read_records(spark, f"{tmp_path}/out")
    assert sorted(r.ord for r in records.collect()) == list(range(50))


def test_json_lines_quarantine(spark, tmp_path):
    folder = tmp_path / "python"
    folder.mkdir()
    good = {"original_id": "1", "language": "python", "raw_content": "é   x", "ord": 4}
    lines = [
        json.dumps(good), "", "   ", '{"raw_content": ', '["x"]', '[{"raw_content": "x"}]',
        '"text"', "5", "null", '{"raw_content": "a"} junk', '{"raw_content": "a"},{"b": 1}',
        "{'raw_content': 'a'}", '{"raw_content": "b", "more": [1]}', '{"ord": "x"}', "{}",
    ]
    (folder / "a.jsonl").write_text("\n".join(lines) + "\n")
    (folder / "b.txt").write_text('{"raw_content": "not read"}\n')
    (folder / "deeper").mkdir()
    (folder / "deeper" / "c.jsonl").write_text('{"raw_content": "not read"}\n')
    (tmp_path / "d.jsonl").write_text('{"raw_content": "not read"}\n')
    records, left_out = read_records(spark, str(tmp_path))
    assert records.columns == [*RECORD.names, "place"]
    rows = records.orderBy("place").collect()
    assert [r.raw_content for r in rows] == ["é   x", "b", None, None]
    assert (rows[0].original_id, rows[0].ord, rows[2].ord) == ("1", 4, None)
    bad = {r.line for r in left_out.collect()}
    assert bad == set(lines[3:12])
    assert records.select("ord").count() == 4


def test_missing_places(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_records(spark, f"{tmp_path}/nowhere")
    pool, left_out = read_pool(spark, f"{tmp_path}/nowhere.jsonl")
    assert pool.schema == POOL and pool.isEmpty() and left_out.isEmpty()


def test_files_that_break_off_give_their_whole_lines(spark, tmp_path):
    folder = tmp_path / "in" / "c"
    lines = [json.dumps({"language": "c", "raw_content": f"text {random.Random(i).random()}"}) for i in range(60_000)]
    text = ("\n".join(lines) + "\n").encode()
    whole = gzip.compress(text)
    half = len(whole) // 2
    flipped = whole[:half] + bytes(x ^ 255 for x in whole[half : half + 9]) + whole[half + 9 :]
    files = {
        "none": ("x.gz", b"\x1f\x8b\x08 not a gzip file"),
        "half": ("y.gz", whole[:half]),
        "fine": ("z.gz", whole[:half] and gzip.compress(text[:1000]) + gzip.compress(text[1000:]) + bytes(512)),
        "flip": ("f.gz", flipped),
        "bits": ("b.bz2", bz2.compress(text)[: half // 2]),
        "zstd": ("s.zst", zstandard.compress(text)[:half]),
        "void": ("v.gz", b""),
    }
    for name, (file, data) in files.items():
        (folder / f"{name}.jsonl").mkdir(parents=True)
        (folder / f"{name}.jsonl" / file).write_bytes(data)
    (folder / "good.jsonl").write_text('{"raw_content": "a", "language": "c"}\n')
    root = f"{tmp_path}/in"
    found = stored_records(spark, root)
    reached = {f.path.rsplit("/", 1)[1]: f.reached for f in found.unreadable}
    assert set(reached) == {"x.gz", "y.gz", "f.gz", "b.bz2", "s.zst"}
    assert reached["y.gz"] == half and half <= reached["f.gz"] <= len(whole)
    read = found.records.select("place.file", "place.row", "raw_content").collect()
    by_file = {}
    for r in read:
        by_file.setdefault(r.file.rsplit("/", 1)[1], {})[r.row] = r.raw_content
    contents = [json.loads(x)["raw_content"] for x in lines]
    assert [by_file["z.gz"][i] for i in range(60_000)] == contents and len(by_file["z.gz"]) == 60_000
    # Flipped bytes may decode to odd lines before the fault shows; those before are right.
    assert sum(by_file["f.gz"].get(i) == c for i, c in enumerate(contents[:20_000])) == 20_000
    for name in ("y.gz", "b.bz2", "s.zst"):
        own = by_file[name]
        assert 1_000 < len(own) < 60_000 and [own[i] for i in range(len(own))] == contents[: len(own)]
    assert found.counts["loaded"] == len(read)
    # What gzip itself gives of the half file.
    rest = zlib.decompressobj(31).decompress(whole[:half])
    assert len(by_file["y.gz"]) == rest.count(b"\n")
    stage = pool_from_jsonl(spark, root, f"{tmp_path}/pool")
    assert {f.path for f in stage.unreadable} == {f.path for f in found.unreadable}
    assert spark.read.parquet(f"{tmp_path}/pool").count() >= 60_001
    with pytest.raises(ValueError, match="y.gz"):
        pool_from_jsonl(spark, root, f"{tmp_path}/pool2", fail_on_unreadable=True)


def test_lines_of_pieces_equal_those_of_the_whole():
    draw = random.Random(3)
    for _ in range(2000):
        text = "".join(draw.choice("ab\r\n") for _ in range(draw.randrange(12))).encode()
        cuts = sorted(draw.randrange(len(text) + 1) for _ in range(draw.randrange(5)))
        pieces = [(0, text[a:b]) for a, b in zip([0, *cuts], [*cuts, len(text)])]
        assert list(split_lines(pieces)) == text.splitlines()


def test_broken_blocks_are_left_out(spark, tmp_path):
    folder = tmp_path / "in" / "c"
    rows = spark.range(2000).selectExpr("'c' AS language", "concat('text ', id) AS raw_content")
    rows.coalesce(1).write.option("compression", "lz4").json(f"{folder}/whole.jsonl")
    rows.coalesce(1).write.option("compression", "lz4").json(f"{folder}/half.jsonl")
    (part,) = (folder / "half.jsonl").glob("*.lz4")
    part.write_bytes(b"\x00\x00\x01\x00" + b"\xff" * 40)
    (folder / "half.jsonl" / f".{part.name}.crc").unlink()
    found = stored_records(spark, f"{tmp_path}/in")
    assert [f.path.rsplit("/", 1)[1] for f in found.unreadable] == [part.name]
    assert found.records.count() == 2000 and found.unreadable[0].reached is None


def test_streams_without_cap_and_with_cap_zero(spark, tmp_path):
    path = f"{tmp_path}/lines"
    spark.range(400).selectExpr("CAST(id AS STRING) AS code").repartition(40).write.json(path)
    assert take(spark, path, "code string", None).count() == 400
    assert take(spark, path, "code string", 0).count() == 0
    source = replace(CODE, stream=True, format="json", schema="code string", max_samples=0)
    spark.range(9).selectExpr("concat('this is the code number ', id) AS code").write.json(
        source.path(str(tmp_path))
    )
    (status,) = extract_all(spark, str(tmp_path), f"{tmp_path}/out", [source])
    assert status.status == "empty"


def test_first_record_follows_file_and_line(spark, tmp_path):
    """Files written elsewhere have no ``ord``: equal keys fall back to the place."""
    for name in ("b", "a"):
        folder = tmp_path / "c"
        folder.mkdir(exist_ok=True)
        (folder / f"{name}.jsonl").write_text(
            "".join(
                json.dumps({"original_id": f"{name}{i}", "source_config_id": "s",
                            "language": "c", "raw_content": f"same {i % 2}"}) + "\n"
                for i in range(6)
            )
        )
    pool_from_jsonl(spark, str(tmp_path), f"{tmp_path}/pool")
    found = spark.read.parquet(f"{tmp_path}/pool").collect()
    assert {r.original_id for r in found} == {"a0", "a1"}


@pytest.fixture
def corpus(spark, tmp_path):
    """Sources of all kinds below one root, some of them faulty."""
    root = f"{tmp_path}/sources"
    flat = replace(CODE, id="flat", hf_name="flat")
    code = [("def f():\n    return 1\n# end", ), ("short",), ("x = [1, 2, 3, 4, 5, 6, 7]",), (None,)]
    spark.createDataFrame(code, "code string").coalesce(1).write.parquet(flat.path(root))
    tagged = Source(
        "contest", "contest", "java", "train", ("description",), "\n// S\n",
        shape=TAGGED_SOLUTIONS,
    )
    spark.createDataFrame(
        [("add two", [("Java 13", "int add() { return 1; }")])],
        "description string, solutions array<struct<language: string, solution: string>>",
    ).write.parquet(tagged.path(root))
    odd = replace(CODE, id="odd", hf_name="odd", content_fields=("body",))
    spark.createDataFrame(code, "code string").write.parquet(odd.path(root))
    empty = replace(CODE, id="empty", hf_name="empty")
    spark.createDataFrame([], "code string").write.parquet(empty.path(root))
    gone = replace(CODE, id="gone", hf_name="gone")
    plain = plain_corpus("plain", "rust")
    spark.createDataFrame(
        [("fn main() { println!(); }",), ("def f():\n    return 1\n# end",)], "text string"
    ).coalesce(1).write.json(plain.path(root))
    return root, [flat, tagged, odd, empty, gone, plain]


def test_stages_from_sources_to_pool(spark, tmp_path, corpus):
    root, sources = corpus
    out = f"{tmp_path}/records"
    report = extract_all(spark, root, out, sources)
    assert [(s.source, s.status, s.processed, s.written, s.zero_yield) for s in report] == [
        ("flat", "done", 4, 2, False),
        ("contest", "done", 1, 0, True),
        ("odd", "missing fields", 0, 0, False),
        ("empty", "empty", 0, 0, False),
        ("gone", "failed", 0, 0, False),
        ("plain", "done", 2, 2, False),
    ]
    assert yield_totals(report) == (7, 4)
    again = extract_all(spark, root, out, sources)
    assert again[0] == report[0]
    records, _ = read_records(spark, out)
    assert records.count() == 4
    duplicates, left_out, _ = pool_from_jsonl(
        spark, out, f"{tmp_path}/pool", f"{tmp_path}/pool.jsonl"
    )
    assert duplicates.head().asDict() == {
        "loaded": 4, "unique_records": 3, "removed_empty": 0, "removed": 1,
        "removed_duplicates": 1,
    }
    assert left_out.isEmpty()
    pool = spark.read.schema(POOL).parquet(f"{tmp_path}/pool").collect()
    kept = {r.raw_content: r for r in pool}
    assert kept["def f():\n    return 1\n# end"].source_config_id == "flat"
    assert kept["fn main() { println!(); }"].characteristics.main_function is True
    back, _ = read_pool(spark, f"{tmp_path}/pool.jsonl")
    assert back.drop("ord").exceptAll(
        spark.read.schema(POOL).parquet(f"{tmp_path}/pool").drop("ord")
    ).isEmpty()


def test_export_has_the_keys_of_its_language(spark, tmp_path):
    rows = [
        ("1", "s", "h", "python", "import b\nimport a\n", 0),
        ("2", "s", "h", "java", "import b;\nclass A {", 1),
        ("3", "s", "h", "Go", "package a", 2),
    ]
    pool = build_pool(spark.createDataFrame(rows, RECORD))
    export_pool(pool, f"{tmp_path}/pool.jsonl")
    found = {}
    for line in spark.read.text(f"{tmp_path}/pool.jsonl").collect():
        record = json.loads(line.value)
        found[record["original_id"]] = record
    assert list(found["1"]) == [
        "original_id", "source_config_id", "source_hf_name", "language", "raw_content",
        "snippet_id", "characteristics",
    ]
    assert found["1"]["characteristics"] == {
        "loc": 2, "num_functions": 0, "num_classes": 0, "imports": ["a", "b"],
        "ast_parse_success": True, "syntax_error_detail": None, "avg_line_length": 9.0,
        "num_comments": 0,
    }
    assert found["2"]["characteristics"]["imports"] == 1
    assert found["3"]["characteristics"] == {"loc": 1, "avg_line_length": 9.0}
    back, _ = read_pool(spark, f"{tmp_path}/pool.jsonl")
    rows = {r.original_id: r.characteristics for r in back.collect()}
    assert rows["1"].imports == ["a", "b"] and rows["1"].num_imports is None
    assert rows["2"].imports is None and rows["2"].num_imports == 1


def test_schemas_are_not_changed_by_reading(spark, tmp_path):
    read_pool(spark, f"{tmp_path}/none")
    assert RECORD.names[-1] == "ord" and len(RECORD) == 6
    assert CHARACTERISTICS["imports"].dataType.simpleString() == "array<string>"


def test_shared_folder_comes_from_the_session(spark):
    folder = shared_folder(spark)
    assert spark.conf.get("spark.checkpoint.dir") == folder
    assert new_path(spark, "x").startswith(folder)
    assert new_path(spark, "x") != new_path(spark, "x")


def test_stage_two_parses_every_line_once(spark, tmp_path):
    folder = tmp_path / "in" / "c"
    folder.mkdir(parents=True)
    lines = [json.dumps({"language": "c", "raw_content": f"t {i % 3}"}) for i in range(9)]
    lines += ["", "broken {", json.dumps({"language": "c", "raw_content": ""}), "{}"]
    (folder / "a.jsonl").write_text("\n".join(lines))
    records, bad, counts, unreadable = stored_records(spark, f"{tmp_path}/in")
    assert unreadable == []
    assert counts == {"loaded": 11, "empty": 2}
    for df in (records, bad):
        assert "from_json" not in df._jdf.queryExecution().optimizedPlan().toString()
    stage = pool_from_jsonl(spark, f"{tmp_path}/in", f"{tmp_path}/pool")
    assert stage.report.head().asDict() == dedup_report(records).head().asDict()
    assert [r.line for r in stage.left_out.collect()] == ["broken {"]


def test_lines_are_numbered_without_moving_them(spark, tmp_path):
    """Many files of many slices, blank lines and lines that are no objects."""
    folder = tmp_path / "corpus" / "train"
    folder.mkdir(parents=True)
    wanted = []
    for k in range(7):
        lines = []
        for i in range(150 * k):
            text = f"file {k} line {i} " + "x" * (i * 7 % 90)
            lines += [json.dumps({"text": text})] + [""] * (i % 5 == 0) + ["no object"] * (i % 11 == 0)
            wanted += [text] + [None] * (i % 11 == 0)
        (folder / f"{k}.json").write_text("\n".join(lines))
    settings = {"spark.sql.files.maxPartitionBytes": "1k", "spark.sql.files.openCostInBytes": "10",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        for cap in (None, 0, 900):
            rows = scan(spark, plain_corpus("corpus", "prose", cap), str(tmp_path))
            found = {r.ord: r.text for r in rows.collect()}
            assert [found[i] for i in range(len(found))] == wanted[:cap]
        rows = scan(spark, plain_corpus("corpus", "prose"), str(tmp_path))
        assert rows.rdd.getNumPartitions() > 50
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "SinglePartition" not in plan
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_sources_run_side_by_side(spark, tmp_path, monkeypatch):
    """The first source waits for all others; one fails; statuses keep their order."""
    others = threading.Barrier(3, timeout=60)
    tags = {}

    def one(spark, source, root, out):
        tags[source.id] = set(spark.sparkContext.getJobTags())
        if source.id != "d":
            others.wait()
        if source.id == "b":
            raise ValueError("broken")
        return [extraction.SourceStatus(source.id, "done")]

    monkeypatch.setattr(extraction, "_extract_one", one)
    sources = [replace(CODE, id=name) for name in "abcd"]
    report = extract_all(spark, str(tmp_path), "", sources)
    assert [(s.source, s.status) for s in report] == [("a", "done"), ("b", "failed"), ("c", "done"), ("d", "done")]
    assert report[1].detail == "broken" and not set(spark.sparkContext.getJobTags())
    assert tags == {s.id: {extraction.job_tag(s)} for s in sources}


def test_files_that_lack_a_field_are_named(spark, tmp_path):
    """Whichever file Spark would take the schema from; also of a capped source."""
    whole = "concat('this is the code number ', id) AS code"
    for name, odd_first in (("one", True), ("two", False)):
        source = replace(CODE, id=name, hf_name=name)
        parts = [("id AS other",), (whole,)] if odd_first else [(whole,), ("id AS other",)]
        for columns in parts:
            spark.range(50).coalesce(1).selectExpr(*columns).write.mode("append").parquet(source.path(str(tmp_path)))
        for cap, rows in ((None, 50), (20, 20)):
            report = extract_all(spark, str(tmp_path), f"{tmp_path}/out", [replace(source, max_samples=cap)])
            assert [(s.status, s.written) for s in report] == [("done", rows), ("missing fields", 0)]
            assert report[1].detail.startswith("code: ") and report[1].detail.count(".parquet") == 1
    source = replace(CODE, id="none", hf_name="none")
    spark.range(5).write.parquet(source.path(str(tmp_path)))
    (status,) = extract_all(spark, str(tmp_path), f"{tmp_path}/out", [source])
    assert (status.status, status.detail) == ("missing fields", "code")
