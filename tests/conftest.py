from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Values of an expression over given rows, in the order of the rows."""

    def run(rows, schema, *expressions):
        frame = spark.createDataFrame(
            [(i, *r) for i, r in enumerate(rows)], f"_i int, {schema}"
        )
        found = frame.select("_i", *expressions).orderBy("_i").collect()
        return [r[1] if len(expressions) == 1 else tuple(r)[1:] for r in found]

    return run
