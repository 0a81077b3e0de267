"""Stored daily counts: a refresh with late rows equals a full recomputation, touching only the days it must;
tables written by date have files that follow each date's size."""

from __future__ import annotations

import tempfile
from dataclasses import replace
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from ticketflow.config import FIXTURE, TICKET_TYPE
from ticketflow.plans import daily_state as D
from ticketflow.plans import panels, summary
from ticketflow.sources import fixtures
from ticketflow.sources.tables import write_partitioned

ALL = (date(1990, 1, 1), date(2010, 1, 1))


@pytest.fixture(scope="module")
def small(spark):
    t = fixtures.load(spark, SMALL)
    return replace(t, tasks=t.tasks.cache(), task_performance=t.task_performance.cache(), task_logs=t.task_logs.cache())


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def path():
    return tempfile.mkdtemp(prefix="tf-days-") + "/days"


def some(df, key, part):
    """A share of the rows, chosen by key."""
    return F.pmod(F.xxhash64(key), F.lit(7)) < part


def test_late_rows_and_versions(spark, small):
    at = path()
    late_p, late_v = some(small, "reporterid", 2), some(small, "id", 3)
    before = replace(small, memo={}, task_performance=small.task_performance.filter(~late_p), tasks=small.tasks.filter(~late_v))
    D.refresh_closures(before, FIXTURE, at)
    assert rows(D.read_days(spark, at, D.CLOSURES)) == rows(panels.closed_outcomes_daily(before, FIXTURE, *ALL))
    D.refresh_closures(small, FIXTURE, at, small.task_performance.filter(late_p), small.tasks.filter(late_v))
    want = rows(panels.closed_outcomes_daily(small, FIXTURE, *ALL))
    assert rows(D.read_days(spark, at, D.CLOSURES)) == want and len(want) > 100
    # repeated, it changes nothing
    D.refresh_closures(small, FIXTURE, at, small.task_performance.filter(late_p), small.tasks.filter(late_v))
    assert rows(D.read_days(spark, at, D.CLOSURES)) == want


def test_only_touched_days_are_counted_again(spark, small):
    at = path()
    D.refresh_closures(small, FIXTURE, at)
    first = spark.read.parquet(at).agg(F.max("run"), F.count("d")).first()
    one = small.task_performance.filter((F.col("task_type") == TICKET_TYPE) & F.col("task_resolved_time").isNotNull()).limit(1)
    days = D.refresh_closures(small, FIXTURE, at, one)
    added = spark.read.parquet(at).filter("run > 0").collect()
    assert tuple(first)[0] == 0 and len(days) == 1 and [(r.run, r.d) for r in added] == [(1, days[0])]
    assert D.refresh_closures(small, FIXTURE, at, one.limit(0), small.tasks.limit(0)) == []


def test_a_day_without_rows_left(spark, small):
    """Rows that are deleted or moved are given as they were: their old day is counted again, and may be empty."""
    at = path()
    D.refresh_closures(small, FIXTURE, at)
    day = D.read_days(spark, at, D.CLOSURES).agg(F.max("d")).first()[0]
    gone = panels.closures_on(small, FIXTURE, [day]).count() == 1
    on_day = F.coalesce(F.to_date(F.col("task_resolved_time") + F.expr("INTERVAL 330 MINUTES")) == F.lit(day), F.lit(False))
    was = small.task_performance.filter(on_day)
    after = replace(small, memo={}, task_performance=small.task_performance.filter(~on_day))
    assert gone and D.refresh_closures(after, FIXTURE, at, was) == [day]
    got = rows(D.read_days(spark, at, D.CLOSURES))
    assert got == rows(panels.closed_outcomes_daily(after, FIXTURE, *ALL)) and all(day not in r for r in got)


def test_weekly_layer_from_state(spark, small):
    closures, assigned = path(), path()
    D.refresh_closures(small, FIXTURE, closures)
    late = F.col("added_time") >= F.lit(FIXTURE.as_of - timedelta(days=9))
    D.refresh_assigned(replace(small, memo={}, task_logs=small.task_logs.filter(~late)), FIXTURE, assigned)
    D.refresh_assigned(small, FIXTURE, assigned, small.task_logs.filter(late))
    stored = D.with_state(small, closures, assigned)
    for panel in (summary.weekly_summary, summary.baseline_ratio, summary.baseline_avg, panels.closed_rolling_7,
                  panels.closed_daily_since_start):
        assert rows(panel(stored, FIXTURE)) == rows(panel(small, FIXTURE)), panel.__name__
    # the closures' panels read no fact table any more
    plan = panels.closed_rolling_7(stored, FIXTURE)._jdf.queryExecution().optimizedPlan().toString()
    assert "reporterid" not in plan and "total_closed" in plan


def test_nothing_stored_and_rows_without_time(spark, small):
    assert D.read_days(spark, path(), D.CLOSURES).collect() == []
    at = path()
    bare = small.task_performance.limit(3).withColumn("task_resolved_time", F.lit(None).cast("timestamp_ntz"))
    assert D.refresh_closures(replace(small, memo={}, task_performance=bare), FIXTURE, at) == []
    assert D.read_days(spark, at, D.CLOSURES).collect() == []


def test_files_follow_the_size_of_a_date(spark):
    """Sixty dates of a few rows held by many tasks, one of most rows: one file each, and the busy one is split."""
    base = datetime(2025, 1, 1)
    df = spark.range(0, 400_000, 1, 16).select(
        F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("x"),
        (F.lit(base) + F.make_dt_interval(F.when(F.col("id") % 200 == 0, (F.col("id") / 200 % 60).cast("int")).otherwise(5)))
        .cast("timestamp_ntz").alias("t"))
    df = df.unionByName(df.limit(1).withColumn("t", F.lit(None).cast("timestamp_ntz")))
    at, old = path(), spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        write_partitioned(df, at, "t")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in Path(at).glob("t__date=*")}
    busy = files.pop("t__date=2025-01-06")
    assert len(files) == 60 and busy >= 4 and max(files.values()) <= 2 and sum(files.values()) < 70
    assert rows(spark.read.parquet(at).select("id", "x", "t").agg(F.count("id"), F.sum("id"))) == rows(df.agg(F.count("id"), F.sum("id")))
