"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from snipmill.catalog.queries import REGISTERED
from snipmill.session import SETTINGS

HEADLINE = (
    "pool_summary",
    "exact_dedup_keep_first",
    "dedup_report",
    "extract_first_field",
    "extract_list_field",
    "extract_nested_solution",
    "extract_json_solutions",
    "yield_report",
    "first_n_per_source",
    "char_generic",
    "char_python_ast",
    "char_c_cpp",
    "char_java",
    "char_rust",
    "char_unified",
    "sample_language",
    "exclude_used",
    "phase_selection_snippets",
    "plan_summary",
    "train_val_split",
    "epoch_batches",
    "sequence_shape",
    "eval_summary",
    "jsonl_round_trip",
    "pool_export_round_trip",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed run, so that no query pays for the start of the JVM's threads,
    # the compiler and the Python workers.
    REGISTERED["char_unified"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        REGISTERED[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
