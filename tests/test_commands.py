"""The stages as commands, one after the other."""

from snipmill.__main__ import main
from snipmill.sources.registry import SOURCES


def test_stages_as_commands(spark, tmp_path, capsys):
    by_id = {s.id: s for s in SOURCES}
    root = str(tmp_path / "sources")
    for id, field in (("codeforces_py", "code"), ("rust_code_snippets_new", "Snippet")):
        spark.range(400).selectExpr(
            f"concat('value_', id, ' = [1, 2, 3, 4, 5]') AS {field}"
        ).write.parquet(by_id[id].path(root))
    solution = "array(named_struct('language', 'C++', 'solution', concat('int main() ', id)))"
    spark.range(300).selectExpr(
        "concat('task number ', id) AS description", f"{solution} AS solutions"
    ).write.parquet(by_id["cpp_code_contests"].path(root))
    main(["extract", root, str(tmp_path / "records")])
    printed = capsys.readouterr().out
    # The two contest sources share their files; none of the rows has Java.
    assert "rows processed, written: 1400 1100" in printed
    main(["pool", str(tmp_path / "records"), str(tmp_path / "pool"),
          "--export", str(tmp_path / "pool.jsonl")])
    assert spark.read.parquet(str(tmp_path / "pool")).count() == 700
    # The selection is the same from both forms of the pool.
    for name in ("pool", "pool.jsonl"):
        main(["select", str(tmp_path / name), str(tmp_path / f"out-{name}")])
    first, second = (
        spark.read.parquet(f"{tmp_path}/out-{name}/selection") for name in ("pool", "pool.jsonl")
    )
    assert first.count() == second.count() and first.exceptAll(second).isEmpty()
    plan = {r.phase: r for r in spark.read.parquet(f"{tmp_path}/out-pool/plan").collect()}
    assert plan["Python_Focus"].total_steps == 765
    assert plan["CPP_Introduction"].val == 34
    assert "Java_Introduction" not in plan
    contents = spark.read.parquet(f"{tmp_path}/out-pool/contents")
    assert contents.where("raw_content IS NULL").isEmpty()
    assert contents.count() == first.count()
    batches = spark.read.parquet(f"{tmp_path}/out-pool/batches")
    assert batches.where("phase = 'Python_Focus' AND part = 'train'").count() == 765
