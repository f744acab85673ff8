"""The stages as commands of ``python -m snipmill``.

    extract ROOT RECORDS            sources below ROOT to JSON Lines
    pool RECORDS POOL [--export F]  records to a pool in Parquet, and JSON Lines
    select POOL OUT                 pool to phases, their languages, batches and the step plan
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from snipmill.operators.reports import language_distribution
from snipmill.operators.splits import BATCH_SIZE, epoch_batches, split_train_validation, step_plan
from snipmill.plans.extraction import extract_all, yield_totals
from snipmill.plans.phases import PHASES, per_phase, select_phases, with_contents
from snipmill.plans.pool import pool_from_jsonl
from snipmill.schemas import POOL
from snipmill.session import build_session, remove_run_folder
from snipmill.sources.jsonl import read_pool


def extract(spark: SparkSession, root: str, records: str) -> None:
    report = extract_all(spark, root, records)
    for status in report:
        print(status)
    print("rows processed, written:", *yield_totals(report))


def pool(spark: SparkSession, records: str, out: str, export: str | None = None) -> None:
    report, left_out, unreadable = pool_from_jsonl(spark, records, out, export)
    for file in unreadable:
        print("not read to its end:", file.path, file.reason, f"({file.reached} bytes read)")
    left_out.write.mode("overwrite").json(f"{out.rstrip('/')}-quarantine")
    report.show()


def select(spark: SparkSession, pool_path: str, out: str, batch_size: int = BATCH_SIZE) -> None:
    if pool_path.rstrip("/").endswith(".jsonl"):
        snippets, _ = read_pool(spark, pool_path)
    else:
        snippets = spark.read.schema(POOL).parquet(pool_path)
    out = out.rstrip("/")
    chosen = select_phases(snippets)
    split = split_train_validation(chosen)
    split.write.mode("overwrite").parquet(f"{out}/selection")
    split = spark.read.schema(split.schema).parquet(f"{out}/selection")
    languages = language_distribution(split, "phase")
    languages.write.mode("overwrite").parquet(f"{out}/languages")
    with_contents(split, snippets).write.mode("overwrite").parquet(f"{out}/contents")
    epochs = per_phase(PHASES, "epochs")
    epoch_batches(split, epochs, batch_size).write.mode("overwrite").parquet(f"{out}/batches")
    plan = step_plan(split, epochs, per_phase(PHASES, "warmup_ratio"), batch_size)
    plan.write.mode("overwrite").parquet(f"{out}/plan")
    order = F.array_position(F.array(*(F.lit(p.name) for p in PHASES)), F.col("phase"))
    spark.read.schema(plan.schema).parquet(f"{out}/plan").orderBy(order).show(truncate=False)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser("snipmill", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("extract")
    one.add_argument("root")
    one.add_argument("records")
    two = commands.add_parser("pool")
    two.add_argument("records")
    two.add_argument("out")
    two.add_argument("--export")
    three = commands.add_parser("select")
    three.add_argument("pool_path")
    three.add_argument("out")
    three.add_argument("--batch-size", type=int, default=BATCH_SIZE)
    chosen = vars(parser.parse_args(arguments))
    stage = {"extract": extract, "pool": pool, "select": select}[chosen.pop("command")]
    spark = build_session()
    stage(spark, **chosen)
    remove_run_folder(spark)


if __name__ == "__main__":
    main()
