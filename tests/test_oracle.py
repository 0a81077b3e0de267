"""Every registered query equals its DuckDB SQL on the sf0.01 tables
(sorted column names, row count, multiset of rows)."""

from __future__ import annotations

import math
from collections import Counter

import pytest

import __spark_entry__ as entry
from ticketflow.plans import registry
from conftest import MEDIUM

NAMES = sorted(registry.queries())


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v.isoformat() if hasattr(v, "isoformat") else v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(registry.oracle_sql()) == set(registry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_matches_duckdb(spark, duck, name):
    df = registry.queries()[name](spark, MEDIUM)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(registry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _bag(df.columns, srows) == _bag(dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["d", "total_closed", "success", "failed", "success_pct", "failed_pct",
                          "success_7d", "failed_7d"]


@pytest.mark.parametrize("name", ["latest_tickets", "first_after", "local_time_parts", "returned_after_success",
                                  "closed_daily", "weekly_summary"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, name):
    """Times are wall-clock TIMESTAMP_NTZ; a session zone with daylight saving
    (wall times in its spring-forward gap exist in the data) changes nothing."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        test_matches_duckdb(spark, duck, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
