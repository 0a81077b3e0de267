"""Rounding of exact doubles, fresh file listings, catalog pruning, empty totals."""

from __future__ import annotations

import tempfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from ticketflow.functions.alerts import signed_pct
from ticketflow.functions.rates import pct
from ticketflow.operators.agg import with_total, zero_fill

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("t", [1000, 2000, 2500, 4000, 6000, 10000])
def test_one_decimal_equals_python(spark, t):
    got = spark.range(t + 1).select("id", pct("id", F.lit(t)).alias("p")).collect()
    assert all(r.p == round(r.id * 100.0 / t, 1) for r in got)


def test_signed_percent(spark):
    row = spark.range(1).select(signed_pct(F.lit(3.4)).alias("a"), signed_pct(F.lit(-0.25)).alias("b"),
                                signed_pct(F.lit(0.0)).alias("c")).first()
    assert (row.a, row.b[0], row.c) == ("+3.4%", "-", "+0.0%")


def test_empty_input_has_a_total_and_every_bucket(spark):
    df = spark.createDataFrame([], "age_bucket string, n long")
    assert [tuple(r) for r in with_total(df, "age_bucket", ["n"]).collect()] == [("Total", 0)]
    buckets = (("a", 0, 7), ("b", None, None))
    assert sorted(tuple(r) for r in zero_fill(df, buckets, ["n"]).collect()) == [("a", 1, 0), ("b", 2, 0)]


def test_appended_files_are_seen(spark):
    from ticketflow.plans import registry
    base = tempfile.mkdtemp(prefix="tf-append-")
    for name in ("orders", "lineitem", "events"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{base}/{name}.parquet")

    def rows():
        return registry.run("json_fields", spark, base).agg(F.sum("audit_rows")).first()[0]
    before = rows()
    spark.read.parquet(f"{SMALL}/events.parquet").write.mode("append").parquet(f"{base}/events.parquet")
    assert rows() == 2 * before


def test_catalog_reads_keep_date_pruning(spark, tables):
    from ticketflow.job import source_tables
    from ticketflow.plans import panels
    from ticketflow.config import FIXTURE
    from ticketflow.sources.tables import SCHEMAS, write_partitioned
    times = {"tasks": "created", "task_performance": "task_resolved_time", "task_logs": "added_time",
             "router_user_mapping": "otp_expiry_time", "device_audit": "modified_time"}
    base = tempfile.mkdtemp(prefix="tf-cat-")
    for name, ts in times.items():
        df = getattr(tables, name)
        full = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                           for f in SCHEMAS[name].fields])
        write_partitioned(full, f"{base}/{name}", ts)
        spark.read.parquet(f"{base}/{name}").createOrReplaceTempView(f"tfp_{name}")
    t = source_tables(spark, prefix="tfp_")
    for panel in (panels.assigned_daily, panels.closed_daily, panels.ra_weekly, panels.pickup_locations,
                  panels.devices_per_location, panels.failed_latest, panels.ra_returned_devices,
                  panels.returned_after_success):
        plan = panel(t, FIXTURE)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(" in plan or "__date" in plan.split("PartitionFilters: [")[1][:200], panel
    want = sorted(map(tuple, panels.assigned_daily(tables, FIXTURE).collect()))
    assert sorted(map(tuple, panels.assigned_daily(t, FIXTURE).collect())) == want


def test_old_baselines_do_not_depend_on_the_lookback(spark, tables):
    from ticketflow.config import FIXTURE
    from ticketflow.plans import summary
    for as_of in (date(2001, 8, 2), date(2001, 12, 20), date(2002, 6, 1)):
        cfg = FIXTURE.replace(as_of=as_of, baseline_start=date(2001, 7, 1), baseline_end=date(2001, 7, 31))
        assert summary.baseline_avg(tables, cfg).first().baseline == summary.baseline_avg(
            tables, cfg.replace(as_of=date(2001, 8, 2))).first().baseline
        rows = {r.metric: r.baseline for r in summary.week_rows(tables, cfg).collect() if r.metric.startswith("Success")}
        alone = {r.metric: r.baseline for r in summary.baseline_ratio(tables, cfg).collect()}
        assert all(alone[m] == b for m, b in rows.items())
