"""Plan shape: filters reach the scan, top-1 is a group limit, anti joins are
anti joins, and no plan has a cartesian product or a Python UDF."""

from __future__ import annotations

import tempfile
from datetime import date

import pytest

import __spark_entry__ as entry
from ticketflow.plans import registry
from conftest import MEDIUM
from ticketflow.config import FIXTURE
from ticketflow.operators import filters as P
from ticketflow.plans import panels


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


def test_local_day_range_is_pushed_to_parquet(spark, tables):
    path = tempfile.mkdtemp(prefix="tf-plan-")
    tables.task_performance.write.mode("overwrite").parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    perf = spark.read.parquet(path)
    df = perf.filter(P.local_date_between("task_resolved_time", date(2001, 4, 4), date(2001, 8, 2), 330))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(task_resolved_time,2001-04-03T18:30" in text
    assert "LessThan(task_resolved_time,2001-08-02T18:30" in text


def test_latest_per_key_has_partial_group_limit(tables):
    text = plan_text(panels.latest_tickets(tables, FIXTURE))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_missing_pickup_is_anti_join(tables):
    assert "LeftAnti" in plan_text(panels.missed_daily(tables, FIXTURE))


def test_fanout_joins_are_counted_not_multiplied(tables):
    # one row per key on the right of every join of the score cohort
    text = plan_text(panels.cohort_score(tables, FIXTURE))
    assert "partial_count" in text


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_cartesian_or_python_udf(spark, name):
    text = plan_text(registry.queries()[name](spark, MEDIUM))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert bad not in text, f"{name}: {bad}"


MAIN_TIME = {"tasks": "created", "task_performance": "task_resolved_time", "task_logs": "added_time",
             "router_user_mapping": "otp_issued_time", "device_audit": "modified_time"}


@pytest.fixture(scope="module")
def small(spark):
    from ticketflow.sources import fixtures
    from conftest import SMALL
    return fixtures.load(spark, SMALL)


@pytest.fixture(scope="module")
def partitioned(spark, small):
    """The five ticket tables stored partitioned by the UTC date of their main time column."""
    from ticketflow.sources.fixtures import Tables
    tables = small
    from ticketflow.sources.tables import SCHEMAS, read, write_partitioned
    from pyspark.sql import functions as F
    base = tempfile.mkdtemp(prefix="tf-parts-")
    out = {}
    for name, ts in MAIN_TIME.items():
        df = getattr(tables, name)
        full = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                           for f in SCHEMAS[name].fields])
        write_partitioned(full, f"{base}/{name}", ts)
        out[name] = read(spark, name, f"{base}/{name}")
    return Tables(ticket_assignments=tables.ticket_assignments, **out)


@pytest.mark.parametrize("panel,part", [("assigned_daily", "added_time__date"),
                                        ("closed_daily", "task_resolved_time__date"),
                                        ("ra_weekly", "modified_time__date"),
                                        ("open_age_status", "created__date")])
def test_time_ranges_prune_date_partitions(spark, small, partitioned, panel, part):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    df = getattr(panels, panel)(partitioned, FIXTURE)
    text = df._jdf.queryExecution().executedPlan().toString()
    filters = [seg.split("]")[0] for seg in text.split("PartitionFilters: [")[1:]]
    assert any(f"({part}" in f and ">=" in f for f in filters), filters
    want = sorted(tuple(r) for r in getattr(panels, panel)(small, FIXTURE).collect())
    assert sorted(tuple(r) for r in df.collect()) == want


def test_building_queries_runs_no_job(spark):
    """Every registered query is a lazy plan: building it starts no Spark job
    (no collect, count or schema sampling on the way), but for those that store a state."""
    tracker = spark.sparkContext.statusTracker()
    qs = registry.queries()
    qs["closed_daily"](spark, MEDIUM)           # table definitions loaded once
    spark.sparkContext.setJobGroup("tf-build", "build only")
    try:
        for name in sorted(set(qs) - registry.STORED):
            qs[name](spark, MEDIUM)
        assert list(tracker.getJobIdsForGroup("tf-build")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
