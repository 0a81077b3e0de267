from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from ticketflow.session import RUNTIME_CONF, ensure_checkpoint_dir

    b = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from ticketflow.sources import fixtures
    return fixtures.load(spark, MEDIUM)


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ["orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{MEDIUM}/{t}.parquet')")
    return con
