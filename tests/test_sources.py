"""The after-success sample CSV and the double-shift check."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from ticketflow.operators.checks import constant_offset
from ticketflow.sources.tables import after_success_csv

CSV = str(Path(__file__).parent / "data" / "after_success_sample.csv")


def test_csv_parses_with_typed_columns(spark):
    df = after_success_csv(spark, CSV)
    rows = df.collect()
    assert len(rows) == 30
    assert df.columns[:3] == ["task_id", "device_id", "partner_id"]
    assert all(r.created_ist is not None and r.resolved_ist is not None and r.ra_returned_ist is not None
               for r in rows)
    assert {r.score for r in rows} == {1}


def test_days_after_success_is_calendar_difference(spark):
    df = after_success_csv(spark, CSV)
    bad = df.filter(F.datediff(F.to_date("ra_returned_ist"), F.to_date("resolved_ist")) != F.col("days_after_success"))
    assert bad.count() == 0


def test_constant_offset_flags_double_shift(spark):
    df = after_success_csv(spark, CSV)
    r = constant_offset(df, "resolved_ist", "ra_returned_ist", 330).first()
    assert (r.rows, r.matching, r.share) == (30, 30, 1.0)
    assert constant_offset(df, "created_ist", "resolved_ist", 330).first().share < 0.5


def test_tables_read_by_catalog_name(spark):
    from datetime import datetime

    from ticketflow.job import source_tables
    from ticketflow.sources.tables import SCHEMAS
    for name, schema in SCHEMAS.items():
        df = spark.createDataFrame([], schema)
        if name == "task_logs":
            df = spark.createDataFrame([("ASSIGN_TICKET_ROUTER_PICKUP", datetime(2025, 12, 1, 20, 0))], schema)
        df.withColumn("extra_col", F.lit(1)).createOrReplaceTempView(f"tfcat_{name}")
    t = source_tables(spark, prefix="tfcat_")
    assert t.tasks.columns == SCHEMAS["tasks"].fieldNames()      # only declared columns, in order
    from ticketflow.config import Config
    from ticketflow.plans import panels
    from datetime import date
    rows = panels.assigned_daily(t, Config(as_of=date(2025, 12, 20))).collect()
    assert [(r.d, r.assigned) for r in rows] == [(date(2025, 12, 2), 1)]   # 20:00 UTC is the next local day
