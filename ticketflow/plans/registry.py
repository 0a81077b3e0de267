"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each entry loads the fixture views over the driver's tables at ``sf_dir`` and
runs one panel with the fixture configuration.  Results leave the plan with
text period labels ('yyyy-MM-dd', 'yyyy-MM') and text times, which is what the
reference's statements return and what compares exactly across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FIXTURE, FIXTURE_LATE, FIXTURE_PARTIAL, OPEN_BUCKETS, Config
from ..functions.buckets import bucket_rank
from ..functions.timeops import day_label, iso_date, local_date, minute_text, ntz_text, period_label
from ..session import ensure_checkpoint_dir
from ..sources import fixtures
from ..sources.fixtures import Tables
from ..operators import checks, sorts, weekly
from . import daily_state, panels, summary
from .oracle import ORACLE


def _labels(df: DataFrame, **cols: str) -> DataFrame:
    """Replace DATE columns by their text label (unit per column), in one projection."""
    return df.select(*[period_label(c, cols[c]).alias(c) if c in cols else F.col(c) for c in df.columns])


def _micro(c: str) -> F.Column:
    return ntz_text(c, "micro")


def _local_time_parts(t: Tables, cfg: Config) -> DataFrame:
    d = local_date("added_time", cfg.offset_minutes)
    wk = F.trunc(d, "week")
    return (t.task_logs.groupBy(period_label(d, "day").alias("d"), period_label(wk, "week").alias("week_start"),
                                period_label(F.trunc(d, "month"), "month").alias("month"),
                                day_label(wk).alias("week_caption"))
            .agg(F.count(F.lit(1)).alias("events")))


def _json_fields(t: Tables, cfg: Config) -> DataFrame:
    from ..functions import jsonops
    a = t.device_audit
    return (a.groupBy(jsonops.text("extra_data", "returnedBy").alias("returned_by"),
                      jsonops.text("extra_data", "router_state").alias("router_state"))
            .agg(F.count(F.lit(1)).alias("audit_rows")))


def _first_after(t: Tables, cfg: Config, max_gap: timedelta | None = None) -> DataFrame:
    from ..operators import filters as P
    from ..operators.joins import first_after
    p = P.not_deleted(t.task_performance).filter(
        F.col("customer_device_id").isNotNull() & F.col("task_resolved_time").isNotNull())
    p = p.select("reporterid", "customer_device_id", "task_resolved_time")
    fa = first_after(p, panels.ra_audit(t), "customer_device_id", "device_id",
                     "task_resolved_time", "modified_time", out="next_return", max_gap=max_gap)
    return fa.select("reporterid", "customer_device_id", _micro("task_resolved_time").alias("resolved_time"),
                     _micro("next_return").alias("next_return"))


def _existence_flag(t: Tables, cfg: Config) -> DataFrame:
    from ..operators.joins import exists_flag
    fp = panels.failed_latest(t, cfg).select("id", "customer_device_id")
    return exists_flag(fp, panels.ra_returned_devices(t, cfg), "customer_device_id", "device_id", "ra_picked")


def _missing_followups(t: Tables, cfg: Config) -> DataFrame:
    from ..operators.joins import missing_followups
    e = panels.eligible_churn(t, cfg).select("router_id", "put_expected_date")
    m = missing_followups(e, panels.pickup_locations(t, cfg), "router_id", "nas_id")
    return _labels(m, put_expected_date="day")


def _returned_after_success(t: Tables, cfg: Config) -> DataFrame:
    r = panels.returned_after_success(t, cfg)
    times = ("created_ist", "resolved_ist", "ra_returned_ist")
    return r.select(*[minute_text(c).alias(c) if c in times else F.col(c) for c in r.columns])


def _next_recharge(t: Tables, cfg: Config) -> DataFrame:
    r = panels.next_recharge(t, cfg)
    return r.select("router_id", "mobile", _micro("issued_ist").alias("issued_ist"), _micro("next_ist").alias("next_ist"))


def _iso_days(t: Tables, cfg: Config) -> DataFrame:
    """F11 on the tables' own times as text: audit rows per ISO date."""
    return t.device_audit.groupBy(iso_date(_micro("modified_time")).alias("_d")).agg(F.count(F.lit(1)).alias("audit_rows")) \
        .select(period_label("_d", "day").alias("d"), "audit_rows")


def _closed_daily_incremental(t: Tables, cfg: Config) -> DataFrame:
    """``closed_daily`` from stored days: built without the last 14 days' closures and ticket versions,
    then brought up to date with them.  Writes its state to the shared checkpoint folder."""
    spark, late = t.tasks.sparkSession, cfg.as_of - timedelta(days=14)
    path = f"{ensure_checkpoint_dir(spark)}/closed-days-{uuid.uuid4().hex}"
    closed, made = F.col("task_resolved_time") >= F.lit(late), F.col("created") >= F.lit(late)
    before = replace(t, memo={}, task_performance=t.task_performance.filter(~closed | closed.isNull()),
                     tasks=t.tasks.filter(~made | made.isNull()))
    daily_state.refresh_closures(before, cfg, path)
    daily_state.refresh_closures(t, cfg, path, t.task_performance.filter(closed), t.tasks.filter(made))
    return _labels(panels.closed_daily(daily_state.with_state(t, path), cfg), d="day")


#: Queries that store a state before they read it; all others start no job until they are read.
STORED = frozenset({"closed_daily_incremental"})

PANELS: dict[str, Callable[[Tables, Config], DataFrame]] = {
    "closed_daily": lambda t, c: _labels(panels.closed_daily(t, c), d="day"),
    "resolution_daily": lambda t, c: _labels(panels.resolution_daily(t, c), d="day"),
    "closed_daily_rates": lambda t, c: _labels(panels.closed_daily_rates(t, c), d="day"),
    "closed_rolling_7": lambda t, c: _labels(panels.closed_rolling_7(t, c), d="day"),
    "closed_daily_since_start": lambda t, c: _labels(panels.closed_daily_since_start(t, c), resolved_date="day"),
    "closed_daily_score": lambda t, c: _labels(panels.closed_daily_score(t, c), resolved_date="day"),
    "closed_rolling_7_score": lambda t, c: _labels(panels.closed_rolling_7_score(t, c), resolved_date="day"),
    "cohort_status": lambda t, c: _labels(panels.cohort_status(t, c), month="month"),
    "cohort_status_rates": lambda t, c: _labels(panels.cohort_status_rates(t, c), month="month"),
    "cohort_status_live": lambda t, c: _labels(panels.cohort_status_live(t, c), month="month"),
    "cohort_score": lambda t, c: _labels(panels.cohort_score(t, c), month="month"),
    "cohort_score_rates": lambda t, c: _labels(panels.cohort_score_rates(t, c), month="month"),
    "open_age_status": panels.open_age_status,
    "open_age_score": panels.open_age_score,
    "open_age_total": summary.open_age_total,
    "danger_total": summary.danger_total,
    "open_age_signals": summary.open_age_signals,
    "failed_latest": lambda t, c: _labels(panels.failed_latest(t, c), failed_date="day"),
    "ra_ageing": panels.ra_ageing,
    "ra_ageing_pct": summary.ra_ageing_pct,
    "ra_ageing_total": summary.ra_ageing_total,
    "ra_signals": summary.ra_signals,
    "pickup_totals": summary.pickup_totals,
    "existence_flag": _existence_flag,
    "ra_weekly": lambda t, c: _labels(panels.ra_weekly(t, c), week_start="week"),
    "weekly_ra_total": lambda t, c: _labels(summary.weekly_ra_total(t, c), week_start="week"),
    "assigned_daily": lambda t, c: _labels(panels.assigned_daily(t, c), d="day"),
    "weekly_avg_assigned": lambda t, c: _labels(summary.weekly_avg_assigned(t, c), week_start="week"),
    "baseline_avg": summary.baseline_avg,
    "missed_daily": lambda t, c: _labels(panels.missed_daily(t, c), d="day"),
    "last_recharge": lambda t, c: _labels(panels.last_recharge(t, c), expire_date="day"),
    "missing_followups": _missing_followups,
    "pickup_locations": panels.pickup_locations,
    "devices_per_location": lambda t, c: panels.devices_per_location(t, c).withColumnRenamed("_devices", "devices"),
    "latest_tickets": lambda t, c: panels.latest_tickets(t, c).select(
        "id", "status", "partner_id", ntz_text("created", "second").alias("created")),
    "returned_after_success": _returned_after_success,
    "first_after": _first_after,
    "first_after_within": lambda t, c: _first_after(t, c, timedelta(days=30)),
    "assignment_delay": panels.assignment_delay,
    "assignment_delay_recent": lambda t, c: panels.assignment_delay(t, c, c.lookback_days),
    "assignment_delay_by_partner": panels.assignment_delay_by_partner,
    "local_time_parts": _local_time_parts,
    "json_fields": _json_fields,
    "weekly_success_ratio": lambda t, c: _labels(
        weekly.ratio(panels.closed_daily(t, c), "d", "success", "total_closed", "success_pct"), week_start="week"),
    "weekly_failed_ratio": lambda t, c: _labels(
        weekly.ratio(panels.closed_daily(t, c), "d", "failed", "total_closed", "failed_pct"), week_start="week"),
    "weekly_resolution_ratio": lambda t, c: _labels(summary.weekly_ratios(t, c).select(
        "week_start", "router_pct", "customer_pct", "general_pct"), week_start="week"),
    "baseline_ratio": summary.baseline_ratio,
    # a baseline older than the lookback of the daily panels
    "baseline_avg_old": lambda t, c: summary.baseline_avg(t, FIXTURE_LATE),
    "baseline_ratio_old": lambda t, c: summary.baseline_ratio(t, FIXTURE_LATE),
    "unreadable_locations": panels.unreadable_locations,
    # options beside the parity forms
    "closed_rolling_7_calendar": lambda t, c: _labels(panels.closed_rolling_7_calendar(t, c), d="day"),
    "closed_rolling_7_by_partner": lambda t, c: _labels(panels.closed_rolling_7_by_partner(t, c), d="day"),
    "ra_ageing_after": panels.ra_ageing_after,
    "missed_customers_daily": lambda t, c: _labels(panels.missed_daily(t, c, True), d="day"),
    "next_recharge": _next_recharge,
    "iso_days": _iso_days,
    "closed_daily_incremental": _closed_daily_incremental,
    "cohort_status_by_partner": lambda t, c: _labels(panels.cohort_status(t, c, ("partner_id",)), month="month"),
    "open_age_by_partner": lambda t, c: panels.open_age_status(t, c, ("partner_id",)),
    "ra_ageing_by_partner": lambda t, c: panels.ra_ageing_by(t, c, ("partner_id",)),
    "baseline_from_panel": lambda t, c: summary.baseline_from_panel(t, FIXTURE_PARTIAL),
    # checks of the inputs
    "bad_json": lambda t, c: checks.bad_json(t.tasks.select("extra_data").unionByName(
        t.device_audit.select("extra_data")), "extra_data"),
    "return_offset": lambda t, c: checks.constant_offset(
        panels.returned_after_success(t, c), "resolved_ist", "ra_returned_ist", c.offset_minutes),
    # result order as a column
    "closed_daily_ordered": lambda t, c: _labels(
        sorts.numbered(panels.closed_daily(t, c), F.col("d").asc_nulls_last()), d="day"),
    "open_age_ordered": lambda t, c: sorts.numbered(
        panels.open_age_status(t, c), bucket_rank("age_bucket", OPEN_BUCKETS)),
    "trend": summary.trend,
    "vs_baseline": summary.vs_baseline,
    "weekly_summary": summary.weekly_summary,
}


def run(name: str, spark: SparkSession, sf_dir: str, cfg: Config = FIXTURE) -> DataFrame:
    """A fresh DataFrame (own query execution) over the shared lazy sub-plans."""
    df = PANELS[name](fixtures.load(spark, sf_dir), cfg)
    return df.select(*[F.col(f"`{c}`") for c in df.columns])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, _n=name: run(_n, spark, sf_dir)) for name in PANELS}


def oracle_sql() -> dict[str, str]:
    return {name: ORACLE[name] for name in PANELS if name in ORACLE}
