"""The reference's statements as DataFrame plans (DATE-typed periods inside).

Each function takes the source ``Tables`` and a ``Config`` and returns a lazy

Where the reference joins only to count the joined rows (a ticket with several
performance rows, a location with several devices), the plans count per key
first and multiply counts after a one-row-per-key join, which gives the same
numbers without emitting the pairs or letting a hot key pile up in one task.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import Config
from ..functions import jsonops
from ..functions.buckets import age_bucket
from ..functions.rates import closed_rate, pct
from ..functions.timeops import add_days, age_days, local_date, period_start, to_local
from ..operators import filters as P
from ..operators.agg import count_by, exact_median, outcome_counts, weighted_counts
from ..operators.dedupe import existing_keys, latest_per_key
from ..operators.joins import (exists_flag, first_after, inner_fanout, inner_filtered, left_filtered, match_counts,
                               missing_followups, only_keys_of, with_latest)
from ..operators.windows import last_events, next_event, rolling_sums
from ..sources.fixtures import Tables


def shared(fn):
    """Build a panel's lazy plan once per (tables, config, arguments).

    Only the DataFrame definition is kept (no data, no executed stages), and only
    as long as its ``Tables``: one query or one refresh."""
    @functools.wraps(fn)
    def wrapper(t, cfg, *args):
        key = (fn.__name__, cfg, args)
        if key not in t.memo:
            t.memo[key] = fn(t, cfg, *args)
        return t.memo[key]
    return wrapper


def ticket_order():
    return [F.col("created").desc_nulls_first(), F.col("status").desc_nulls_first()]


def audit_order():
    return [F.col("modified_time").desc_nulls_first(), F.col("nas_id").asc_nulls_last()]


def failed_perf_order():
    return [F.col("task_resolved_time").desc_nulls_first(), F.col("customer_device_id").asc_nulls_last()]


# ---------------------------------------------------------------- shared inputs

@shared
def latest_tickets(t: Tables, cfg: Config, cols=("id", "created", "status", "partner_id"),
                   created_from=None) -> DataFrame:
    """Latest version of every pickup ticket (type filter before the window,
    status filters after it).

    ``created_from`` (a local date) serves panels that keep only tickets whose
    latest version was created on or after it: versions created earlier can
    never be that latest version, so they are dropped before the window (a raw
    range that reaches the scan and prunes date partitions).  NULL times stay,
    since NULL sorts as the latest."""
    src = P.eq(t.tasks, "type", C.TICKET_TYPE)
    if created_from is not None:
        src = P.on_local_days(src, "created", created_from, None, cfg.offset_minutes, keep_null=True)
    return latest_per_key(src.select(*cols), ["id"], ticket_order())


def latest_tickets_of(t: Tables, cols, keys: DataFrame, key: str) -> DataFrame:
    """``latest_tickets`` of the tickets in ``keys`` (and a few more): versions of other tickets
    are dropped in the scan's tasks, ahead of the partial top-1 and its shuffle."""
    src = P.eq(t.tasks, "type", C.TICKET_TYPE).select(*cols)
    return latest_per_key(only_keys_of(src, "id", keys, key), ["id"], ticket_order())


def live_performance(t: Tables, pickup_only: bool = True) -> DataFrame:
    p = P.not_deleted(t.task_performance)
    return P.eq(p, "task_type", C.TICKET_TYPE) if pickup_only else p


def ra_audit(t: Tables) -> DataFrame:
    """Audit rows recording a device returned to the office by the RA team."""
    a = t.device_audit
    # Two path reads: the second runs only on rows whose first already matched
    # (measured faster than building a struct with from_json for every row).
    return a.filter((jsonops.text("extra_data", "returnedBy") == C.RA_RETURNED_BY)
                    & (jsonops.text("extra_data", "router_state") == C.RA_ROUTER_STATE))


# ---------------------------------------------------------------- closures per day

@shared
def closed_outcomes_daily(t: Tables, cfg: Config, lo, hi, by: tuple[str, ...] = ()) -> DataFrame:
    """alert.Q3 + alert.Q3c in one aggregate: performance rows resolved on local
    days [lo, hi], outcome from the latest ticket version (status-based); ``by``
    names further columns of that version to group by.  Stored days
    (``daily_state``) are taken where the tables have them."""
    if t.closures is not None and not by:
        return t.closures.filter(P.in_range("d", lo, hi))
    p = P.on_local_days(live_performance(t), "task_resolved_time", lo, hi, cfg.offset_minutes)
    return _closed_outcomes(t, cfg, p, by)


def closures_on(t: Tables, cfg: Config, days: Sequence[date]) -> DataFrame:
    """``closed_outcomes_daily`` of the named local days, counted from the facts."""
    return _closed_outcomes(t, cfg, P.on_days(live_performance(t), "task_resolved_time", days, cfg.offset_minutes))


def _closed_outcomes(t: Tables, cfg: Config, p: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Outcomes per local day of the performance rows ``p``."""
    # One row per (ticket, local day, resolution type) with its row count: a
    # ticket carrying a large share of the performance rows is collapsed
    # map-side before the status lookup shuffles by ticket id.
    per = p.groupBy("reporterid", local_date("task_resolved_time", cfg.offset_minutes).alias("d"), "task_resolution_type") \
        .agg(F.count(F.lit(1)).alias("_n"))
    # Only versions of closed tickets are deduped.  The filter on ``_n`` drops nothing: it keeps the
    # count in the sketch's branch, so both branches share one shuffle of ``per``.
    lt = latest_tickets_of(t, ("id", "created", "status", *by), per.filter(F.col("_n") > 0), "reporterid")
    j = with_latest(per, lt, "reporterid", "id", ["status", *by])
    st, rt, n = F.col("status"), F.col("task_resolution_type"), F.col("_n")
    ok = st == C.STATUS_SUCCESS

    def rows_if(cond):
        return F.when(cond, n).otherwise(0)

    return weighted_counts(j, [*by, "d"], {
        "total_closed": n,
        "success": rows_if(ok),
        "failed": rows_if(st == C.STATUS_FAILED),
        "router_recovered": rows_if(ok & (rt == C.RES_ROUTER)),
        "customer_recovered": rows_if(ok & (rt == C.RES_CUSTOMER)),
        "general_success": rows_if(ok & P.any_of(rt == C.RES_GENERAL, P.is_null(rt))),
    })


@shared
def closed_daily(t: Tables, cfg: Config) -> DataFrame:
    lo = cfg.as_of - timedelta(days=cfg.lookback_days)
    return closed_outcomes_daily(t, cfg, lo, cfg.as_of).select("d", "total_closed", "success", "failed")


@shared
def resolution_daily(t: Tables, cfg: Config) -> DataFrame:
    lo = cfg.as_of - timedelta(days=cfg.lookback_days)
    return closed_outcomes_daily(t, cfg, lo, cfg.as_of).select(
        "d", "total_closed", "router_recovered", "customer_recovered", "general_success")


@shared
def closed_daily_rates(t: Tables, cfg: Config) -> DataFrame:
    """Shares of all closed rows; an empty day divides by 1 (alert job)."""
    d = closed_daily(t, cfg)
    return d.select("*",
                    pct("success", "total_closed", 1, on_zero="one").alias("success_pct"),
                    pct("failed", "total_closed", 1, on_zero="one").alias("failed_pct"))


@shared
def closed_rolling_7(t: Tables, cfg: Config) -> DataFrame:
    """W7 on top of G9: 7-row trailing ratio of sums (the alert job's daily panel)."""
    r = rolling_sums(closed_daily_rates(t, cfg), "d", ["success", "failed", "total_closed"],
                     cfg.rolling_rows)
    return r.select("d", "total_closed", "success", "failed", "success_pct", "failed_pct",
                    pct("success_roll", "total_closed_roll").alias("success_7d"),
                    pct("failed_roll", "total_closed_roll").alias("failed_7d"))


@shared
def closed_rolling_7_calendar(t: Tables, cfg: Config) -> DataFrame:
    """``closed_rolling_7`` over seven calendar days: a day without closures shortens the sum."""
    r = rolling_sums(closed_daily(t, cfg), "d", ["success", "failed", "total_closed"], cfg.rolling_rows, calendar=True)
    return r.select("d", "total_closed", pct("success_roll", "total_closed_roll").alias("success_7d"),
                    pct("failed_roll", "total_closed_roll").alias("failed_7d"))


@shared
def closed_rolling_7_by_partner(t: Tables, cfg: Config) -> DataFrame:
    """Closures per partner and day with the partner's own 7-row rolling rates."""
    lo = cfg.as_of - timedelta(days=cfg.lookback_days)
    d = closed_outcomes_daily(t, cfg, lo, cfg.as_of, ("partner_id",))
    r = rolling_sums(d, "d", ["success", "failed", "total_closed"], cfg.rolling_rows, by=["partner_id"])
    return r.select("partner_id", "d", "total_closed", "success", "failed",
                    pct("success_roll", "total_closed_roll").alias("success_7d"),
                    pct("failed_roll", "total_closed_roll").alias("failed_7d"))


@shared
def closed_daily_since_start(t: Tables, cfg: Config) -> DataFrame:
    """live.Q2 + its rates: from the fixed start date, recovery % and 7-row rolling %."""
    d = closed_outcomes_daily(t, cfg, cfg.cohort_start, cfg.as_of).select(
        F.col("d").alias("resolved_date"), F.col("total_closed").alias("total_resolved"),
        F.col("success").alias("recovered"), "failed")
    return _live_daily_rates(d, cfg)


def _live_daily_rates(d: DataFrame, cfg: Config) -> DataFrame:
    r = rolling_sums(d, "resolved_date", ["recovered", "total_resolved"], cfg.rolling_rows)
    return r.select("resolved_date", "total_resolved", "recovered", "failed",
                    pct("recovered", "total_resolved").alias("recovery_pct"),
                    pct("recovered_roll", "total_resolved_roll").alias("rolling_7d_pct"))


@shared
def closed_daily_score(t: Tables, cfg: Config) -> DataFrame:
    """score.Q2: performance rows only, outcome from the score."""
    off = cfg.offset_minutes
    p = P.on_local_days(live_performance(t), "task_resolved_time", cfg.cohort_start, cfg.as_of, off)
    p = p.select("score", local_date("task_resolved_time", off).alias("resolved_date"))
    sc = F.col("score")
    return outcome_counts(p, ["resolved_date"], "total_resolved", {
        "recovered": sc == C.SCORE_RECOVERED, "failed": sc == C.SCORE_FAILED})


@shared
def closed_rolling_7_score(t: Tables, cfg: Config) -> DataFrame:
    return _live_daily_rates(closed_daily_score(t, cfg), cfg)


# ---------------------------------------------------------------- creation cohorts

@shared
def cohort_status(t: Tables, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """alert.Q3b / live.Q1: latest versions created in [start, as_of - 21 days],
    by local creation month (and by the columns ``by`` of that version)."""
    off = cfg.offset_minutes
    lt = latest_tickets(t, cfg, ("id", "created", "status", *by), cfg.cohort_start).filter(
        P.matured("created", cfg.as_of, cfg.cohort_start, cfg.maturity_days, off))
    lt = lt.select("status", *by, period_start(local_date("created", off), "month").alias("month"))
    st = F.col("status")
    return outcome_counts(lt, [*by, "month"], "total_created", {
        "success": st == C.STATUS_SUCCESS,
        "failed": st == C.STATUS_FAILED,
        "open_tickets": P.in_set(st, C.STATUS_OPEN),
    })


@shared
def cohort_status_rates(t: Tables, cfg: Config) -> DataFrame:
    """Rates over closed = success + failed, NULL when nothing closed."""
    m = cohort_status(t, cfg)
    return m.select("*", (F.col("success") + F.col("failed")).alias("closed"),
                    closed_rate("success", "success", "failed").alias("success_pct"),
                    closed_rate("failed", "success", "failed").alias("failed_pct"))


@shared
def cohort_status_live(t: Tables, cfg: Config) -> DataFrame:
    """live.Q1 with the live job's naming and rate: recovered, closed and
    recovery % over closed (NULL when nothing closed)."""
    m = cohort_status(t, cfg).withColumnRenamed("success", "recovered")
    return m.select("*", (F.col("recovered") + F.col("failed")).alias("closed"),
                    closed_rate("recovered", "recovered", "failed").alias("recovery_pct"))


def _tickets_with_perf_counts(t: Tables, cfg: Config, lo, hi, label: Column) -> DataFrame:
    """Every pickup ticket row (versions not deduplicated) created on local days
    [lo, hi], as (id, label, ``_v`` rows), with per-ticket counts of its live
    performance rows."""
    off = cfg.offset_minutes
    tk = P.on_local_days(P.eq(t.tasks, "type", C.TICKET_TYPE), "created", lo, hi, off)
    # Both sides are counted per ticket first (combined map-side: one row per
    # ticket, label and map task leaves the scan), joined after.
    tk = tk.groupBy("id", label).agg(F.count(F.lit(1)).alias("_v"))
    # only performance rows of these tickets are counted (the filter on ``_v`` drops nothing, see ``_closed_outcomes``)
    perf = only_keys_of(P.not_deleted(t.task_performance), "reporterid", tk.filter(F.col("_v") > 0), "id")
    counts = match_counts(perf, "reporterid", {
        "_rec": F.col("score") == C.SCORE_RECOVERED,
        "_fail": F.col("score") == C.SCORE_FAILED,
        "_unres": F.col("task_resolved_time").isNull(),
    })
    return left_filtered(tk, counts, tk["id"] == counts["_mk"])


@shared
def cohort_score(t: Tables, cfg: Config) -> DataFrame:
    """score.Q1: tickets LEFT JOIN performance, counted per joined row by local
    creation month (classes may overlap: score 0 and unresolved is both)."""
    month = period_start(local_date("created", cfg.offset_minutes), "month").alias("month")
    j = _tickets_with_perf_counts(t, cfg, cfg.cohort_start, cfg.as_of, month)
    v, one = F.col("_v"), F.lit(1)
    return weighted_counts(j, ["month"], {
        "total_created": v * F.coalesce("_n", one),
        "recovered": v * F.coalesce("_rec", F.lit(0)),
        "failed": v * F.coalesce("_fail", F.lit(0)),
        "open_tickets": v * F.coalesce("_unres", one),
    })


@shared
def cohort_score_rates(t: Tables, cfg: Config) -> DataFrame:
    m = cohort_score(t, cfg)
    return m.select("*", (F.col("recovered") + F.col("failed")).alias("closed"),
                    closed_rate("recovered", "recovered", "failed").alias("recovery_pct"))


# ---------------------------------------------------------------- open ticket age

@shared
def open_age_status(t: Tables, cfg: Config, by: tuple[str, ...] = ()) -> DataFrame:
    """alert.Q4 / live.Q3: latest version open (status 0/1), created since the
    start date, by age bucket (and by the columns ``by`` of that version)."""
    off = cfg.offset_minutes
    lt = latest_tickets(t, cfg, ("id", "created", "status", *by), cfg.cohort_start).filter(
        P.in_set("status", C.STATUS_OPEN) & P.local_date_between("created", cfg.cohort_start, None, off))
    b = age_bucket(age_days(local_date("created", off), cfg.as_of), C.OPEN_BUCKETS)
    return lt.groupBy(*by, b.alias("age_bucket")).agg(F.count(F.lit(1)).alias("open_tickets"))


@shared
def open_age_score(t: Tables, cfg: Config) -> DataFrame:
    """score.Q3: ticket rows with no live performance row, plus one row per
    unresolved performance row, by age bucket."""
    off = cfg.offset_minutes
    b = age_bucket(age_days(local_date("created", off), cfg.as_of), C.OPEN_BUCKETS).alias("age_bucket")
    j = _tickets_with_perf_counts(t, cfg, cfg.cohort_start, None, b)
    j = j.withColumn("_w", F.col("_v") * F.coalesce("_unres", F.lit(1))).filter(F.col("_w") > 0)
    return j.groupBy("age_bucket").agg(F.sum("_w").cast("bigint").alias("open_tickets"))


# ---------------------------------------------------------------- RA team

@shared
def failed_latest(t: Tables, cfg: Config) -> DataFrame:
    """One row per failed pickup ticket, with the local day of its failure."""
    off = cfg.offset_minutes
    return _failed_rows(t, cfg).select(
        F.col("reporterid").alias("id"), "customer_device_id",
        local_date("task_resolved_time", off).alias("failed_date"),
        age_days(local_date("task_resolved_time", off), cfg.as_of).alias("days_since_fail"))


@shared
def _failed_rows(t: Tables, cfg: Config) -> DataFrame:
    """Of each failed pickup ticket (any version with status 3) the live
    performance row that names a device and was resolved (local time) in the
    lookback: the one resolved last (then lowest device id).  The version order
    does not change which row that is, so versions are reduced to existence first."""
    off = cfg.offset_minutes
    failed_ids = existing_keys(
        t.tasks.filter((F.col("type") == C.TICKET_TYPE) & (F.col("status") == C.STATUS_FAILED)), "id")
    perf = P.since(P.not_deleted(t.task_performance), "task_resolved_time", cfg.as_of, cfg.lookback_days, off) \
        .filter(P.not_null("customer_device_id"))
    best = latest_per_key(perf.select("reporterid", "customer_device_id", "task_resolved_time"),
                          ["reporterid"], failed_perf_order())
    return best.join(failed_ids, best["reporterid"] == failed_ids["id"], "left_semi")


def _office_returns(t: Tables, cfg: Config) -> DataFrame:
    """Returns by the RA team in the lookback (office account only)."""
    return P.since(ra_audit(t), "modified_time", cfg.as_of, cfg.ra_lookback_days) \
        .filter(F.col("lco_account_id").isNull())


@shared
def ra_returned_devices(t: Tables, cfg: Config) -> DataFrame:
    return existing_keys(_office_returns(t, cfg), "device_id")


@shared
def ra_ageing(t: Tables, cfg: Config) -> DataFrame:
    """alert.Q6: failed tickets by days since failure, device returned or not.
    Counted per (device, bucket) before the device lookup, so a device with
    many failed tickets is one row at the join."""
    fp = failed_latest(t, cfg)
    per = fp.groupBy(F.col("customer_device_id").alias("device"),
                     age_bucket("days_since_fail", C.RA_BUCKETS).alias("age_bucket")) \
        .agg(F.count(F.lit(1)).alias("_n"))
    flagged = exists_flag(per, ra_returned_devices(t, cfg), "device", "device_id", "_picked")
    n, picked = F.col("_n"), F.col("_picked")
    return weighted_counts(flagged, ["age_bucket"], {
        "total_failed": n,
        "ra_picked": F.when(picked, n).otherwise(0),
        "still_pending": F.when(~picked, n).otherwise(0),
    })


@shared
def ra_ageing_by(t: Tables, cfg: Config, by: tuple[str, ...]) -> DataFrame:
    """``ra_ageing`` by columns of the latest ticket version as well.  Only versions of the failed
    tickets are deduped; each failed ticket is one row on both sides of that join."""
    # the filter on the date drops nothing: it keeps the columns in the sketch's branch, so both share one shuffle
    fp = failed_latest(t, cfg)
    lt = latest_tickets_of(t, ("id", "created", "status", *by), fp.filter(F.col("failed_date").isNotNull()), "id")
    fp = fp.join(lt.select(F.col("id").alias("_id"), *by), F.col("id") == F.col("_id"), "inner")
    per = fp.groupBy(*by, F.col("customer_device_id").alias("device"),
                     age_bucket("days_since_fail", C.RA_BUCKETS).alias("age_bucket")) \
        .agg(F.count(F.lit(1)).alias("_n"))
    flagged = exists_flag(per, ra_returned_devices(t, cfg), "device", "device_id", "_picked")
    n, picked = F.col("_n"), F.col("_picked")
    return weighted_counts(flagged, [*by, "age_bucket"], {
        "total_failed": n,
        "ra_picked": F.when(picked, n).otherwise(0),
        "still_pending": F.when(~picked, n).otherwise(0),
    })


@shared
def ra_ageing_after(t: Tables, cfg: Config) -> DataFrame:
    """``ra_ageing`` where only a return later than the failure counts.  A device has
    one exactly when its latest return is later, so one row per device is joined;
    failures are counted per (device, time) before."""
    off = cfg.offset_minutes
    days = age_days(local_date("task_resolved_time", off), cfg.as_of)
    per = _failed_rows(t, cfg).groupBy(
        F.col("customer_device_id").alias("device"), "task_resolved_time",
        age_bucket(days, C.RA_BUCKETS).alias("age_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    last = _office_returns(t, cfg).filter(F.col("device_id").isNotNull()).groupBy("device_id") \
        .agg(F.max("modified_time").alias("_last"))
    j = per.join(last, per["device"] == last["device_id"], "left")
    n, picked = F.col("_n"), F.coalesce(F.col("_last") > F.col("task_resolved_time"), F.lit(False))
    return weighted_counts(j, ["age_bucket"], {
        "total_failed": n,
        "ra_picked": F.when(picked, n).otherwise(0),
        "still_pending": F.when(~picked, n).otherwise(0),
    })


@shared
def ra_weekly(t: Tables, cfg: Config) -> DataFrame:
    """alert.Q6b: RA return audit rows per local ISO week (rows, not devices)."""
    off = cfg.offset_minutes
    a = P.since(ra_audit(t), "modified_time", cfg.as_of, cfg.lookback_days, off)
    wk = period_start(local_date("modified_time", off), "week")
    return count_by(a, [wk.alias("week_start")], "ra_returns")


# ---------------------------------------------------------------- assignments

@shared
def assigned_daily(t: Tables, cfg: Config) -> DataFrame:
    """alert.Q2: assignment events per local day; the lookback is on raw time."""
    off = cfg.offset_minutes
    lg = P.since(P.eq(t.task_logs, "event_name", C.ASSIGN_EVENT), "added_time", cfg.as_of, cfg.lookback_days)
    return count_by(lg, [local_date("added_time", off).alias("d")], "assigned")


@shared
def assigned_between(t: Tables, cfg: Config, lo, hi) -> DataFrame:
    """Assignment events per local day in [lo, hi]; stored days are taken where the tables have them."""
    if t.assigned is not None:
        return t.assigned.filter(P.in_range("d", lo, hi))
    off = cfg.offset_minutes
    lg = P.on_local_days(P.eq(t.task_logs, "event_name", C.ASSIGN_EVENT), "added_time", lo, hi, off)
    return count_by(lg, [local_date("added_time", off).alias("d")], "assigned")


def assigned_on(t: Tables, cfg: Config, days: Sequence[date]) -> DataFrame:
    """Assignment events of the named local days, counted from the log."""
    lg = P.on_days(P.eq(t.task_logs, "event_name", C.ASSIGN_EVENT), "added_time", days, cfg.offset_minutes)
    return count_by(lg, [local_date("added_time", cfg.offset_minutes).alias("d")], "assigned")


@shared
def assignment_delay(t: Tables, cfg: Config, days: int | None = None) -> DataFrame:
    """X2 (inferred): tickets assigned, share within 24 h, median hours from the
    latest ticket version's creation to assignment (any ticket type: the
    assignment log itself is pickup-only).  The median is exact and computed
    from bounded histograms (``agg.exact_median``), never from one task
    holding every delay.  ``days`` keeps the assignments of that many local days up
    to the as-of date, and then only their tickets' versions are deduped."""
    a, versions = t.ticket_assignments, t.tasks.select("id", "created", "status")
    if days is not None:
        a = P.on_local_days(a, "assigned_time", cfg.as_of - timedelta(days=days), cfg.as_of, cfg.offset_minutes)
        versions = only_keys_of(versions, "id", a, "ticket_id")
    lt = latest_per_key(versions, ["id"], ticket_order())
    j = inner_fanout(a, lt, a["ticket_id"] == lt["id"]).select(
        F.timestamp_diff("SECOND", F.col("created"), F.col("assigned_time")).alias("secs"))
    # one histogram of delays serves the counts and the median
    hist = j.groupBy("secs").agg(F.count(F.lit(1)).alias("n"))
    counts = hist.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tickets"),
                      F.coalesce(F.sum(F.when(F.col("secs") <= 24 * 3600, F.col("n"))), F.lit(0)).alias("within_24h"),
                      F.lit(None).cast("double").alias("_median"))
    med = exact_median(hist, "secs", 3600, "_median", "n").select(
        F.lit(None).cast("bigint").alias("tickets"), F.lit(None).cast("bigint").alias("within_24h"), "_median")
    # two one-row results merged by a union and one aggregate (no join needed)
    return counts.unionByName(med).agg(F.max("tickets").alias("tickets"), F.max("within_24h").alias("within_24h"),
                                       (F.max("_median") / F.lit(3600.0)).alias("median_hours"))


@shared
def assignment_delay_by_partner(t: Tables, cfg: Config) -> DataFrame:
    """``assignment_delay`` for each partner of the latest ticket version.  Delays are counted per (partner,
    second) before anything else, so a partner with most tickets is as many rows as it has delays."""
    lt = latest_per_key(t.tasks.select("id", "created", "status", "partner_id"), ["id"], ticket_order())
    a = t.ticket_assignments
    j = inner_fanout(a, lt, a["ticket_id"] == lt["id"]).select(
        lt["partner_id"], F.timestamp_diff("SECOND", F.col("created"), F.col("assigned_time")).alias("secs"))
    hist = j.groupBy("partner_id", "secs").agg(F.count(F.lit(1)).alias("n"))
    counts = hist.groupBy(F.col("partner_id").alias("_p")).agg(
        F.sum("n").alias("tickets"), F.sum(F.when(F.col("secs") <= 24 * 3600, F.col("n")).otherwise(0)).alias("within_24h"))
    med = exact_median(hist, "secs", 3600, "_median", "n", ["partner_id"])
    j = counts.join(med, F.col("_p").eqNullSafe(F.col("partner_id")), "left")
    return j.select(F.col("_p").alias("partner_id"), "tickets", "within_24h", (F.col("_median") / F.lit(3600.0)).alias("median_hours"))


# ---------------------------------------------------------------- churned, no pickup

@shared
def eligible_churn(t: Tables, cfg: Config) -> DataFrame:
    """Last recharge per router (W6: LEAD(issued) IS NULL) of completed
    multi-device recharges, expired past the grace period within the lookback."""
    off = cfg.offset_minutes
    last = last_events(_recharges(t), "router_nas_id", "otp_issued_time", tie_cols=["otp_expiry_time"])
    e = last.filter(P.expired_before("otp_expiry_time", cfg.as_of, cfg.churn_grace_days, off)
                    & P.lookback("otp_expiry_time", cfg.as_of, cfg.expiry_lookback_days, off))
    expected = F.to_date(add_days(to_local("otp_expiry_time", off), cfg.expected_after_days, is_date=False))
    return e.select(F.col("router_nas_id").alias("router_id"), "mobile",
                    to_local("otp_expiry_time", off).alias("expire_ist"),
                    expected.alias("put_expected_date"))


@shared
def pickup_locations(t: Tables, cfg: Config) -> DataFrame:
    """Locations (nas ids from the ticket JSON) with a recent pickup ticket."""
    tk = P.since(P.eq(t.tasks, "type", C.TICKET_TYPE), "created", cfg.as_of, cfg.puts_lookback_days)
    return existing_keys(tk, jsonops.number("extra_data", "nas_id"), "nas_id")


@shared
def unreadable_locations(t: Tables, cfg: Config) -> DataFrame:
    """Recent pickup tickets, and how many have no readable location id (their
    customers count as missed)."""
    tk = P.since(P.eq(t.tasks, "type", C.TICKET_TYPE), "created", cfg.as_of, cfg.puts_lookback_days)
    return tk.agg(F.count(F.lit(1)).alias("tickets"),
                  F.count_if(jsonops.number("extra_data", "nas_id").isNull()).alias("unreadable"))


@shared
def devices_per_location(t: Tables, cfg: Config) -> DataFrame:
    """Latest audit row per device in the lookback, counted per location."""
    a = P.since(t.device_audit, "modified_time", cfg.as_of, cfg.audit_lookback_days)
    latest = latest_per_key(a.select("device_id", "nas_id", "modified_time"), ["device_id"], audit_order())
    return latest.groupBy(F.col("nas_id").alias("lng_nas_id")).agg(F.count(F.lit(1)).alias("_devices"))


@shared
def missed_daily(t: Tables, cfg: Config, customers: bool = False) -> DataFrame:
    """alert.Q1: churned customers with a device still at their location and no
    pickup ticket, by expected pickup day.  The reference's join with the
    audit multiplies a customer by the devices at the location; that is done
    here by multiplying counts; ``customers`` counts every customer once."""
    e = eligible_churn(t, cfg).filter(P.date_window("put_expected_date", cfg.as_of, cfg.expected_window_days))
    per = e.groupBy("router_id", "put_expected_date").agg(F.count(F.lit(1)).alias("_n"))
    per = missing_followups(per, pickup_locations(t, cfg), "router_id", "nas_id")
    dev = devices_per_location(t, cfg)
    if customers:
        return per.join(dev, per["router_id"] == dev["lng_nas_id"], "left_semi") \
            .groupBy(F.col("put_expected_date").alias("d")).agg(F.sum("_n").cast("bigint").alias("missed_customers"))
    j = per.join(dev, per["router_id"] == dev["lng_nas_id"], "inner")
    return j.groupBy(F.col("put_expected_date").alias("d")) \
        .agg(F.sum(F.col("_n") * F.col("_devices")).cast("bigint").alias("missed_puts"))


def _recharges(t: Tables) -> DataFrame:
    return P.gt(P.eq(P.eq(t.router_user_mapping, "otp", C.OTP_DONE), "store_group_id", 0), "device_limit", 1)


@shared
def last_recharge(t: Tables, cfg: Config) -> DataFrame:
    """W6 on its own: recharges without a later one of the same router."""
    last = last_events(_recharges(t), "router_nas_id", "otp_issued_time", tie_cols=["otp_expiry_time"])
    return last.select(F.col("router_nas_id").alias("router_id"), "mobile",
                       local_date("otp_expiry_time", cfg.offset_minutes).alias("expire_date"))


@shared
def next_recharge(t: Tables, cfg: Config) -> DataFrame:
    """W6 with its value: every completed recharge and the router's next one (local times)."""
    off = cfg.offset_minutes
    n = next_event(_recharges(t), "router_nas_id", "otp_issued_time", tie_cols=["otp_expiry_time"], out="_next")
    return n.select(F.col("router_nas_id").alias("router_id"), "mobile",
                    to_local("otp_issued_time", off).alias("issued_ist"), to_local("_next", off).alias("next_ist"))


# ---------------------------------------------------------------- returned after success

@shared
def returned_after_success(t: Tables, cfg: Config) -> DataFrame:
    """X1 (inferred from the sample): live score-1 performance rows of pickup
    tickets (type taken from the latest ticket version) resolved (local) in the
    last ``after_success_days`` days whose device the RA team returned later
    (any RA return audit row, as in the weekly RA panel); the first such
    return, with the calendar-day gap.  Each time is shifted once; the return
    must be strictly after the resolution."""
    off = cfg.offset_minutes
    lo = cfg.as_of - timedelta(days=cfg.after_success_days)
    p = P.on_local_days(P.not_deleted(t.task_performance), "task_resolved_time", lo, cfg.as_of, off) \
        .filter((F.col("score") == C.SCORE_RECOVERED) & P.not_null("customer_device_id"))
    p = p.select("reporterid", "customer_device_id", "task_resolution_type", "score", "task_resolved_time")
    # a return later than a resolution is later than the first resolution day's start
    ra = P.on_local_days(ra_audit(t), "modified_time", lo, None, off).select("device_id", "modified_time")
    fa = first_after(p, ra, "customer_device_id", "device_id", "task_resolved_time", "modified_time",
                     out="ra_time").filter(F.col("ra_time").isNotNull())
    lt = latest_tickets_of(t, ("id", "created", "status", "partner_id"), p, "reporterid")
    fa = inner_filtered(fa, lt, fa["reporterid"] == lt["id"])
    return fa.select(
        F.col("reporterid").alias("task_id"),
        F.col("customer_device_id").alias("device_id"),
        "partner_id",
        F.col("task_resolution_type").alias("resolution_type"),
        "score",
        to_local("created", off).alias("created_ist"),
        to_local("task_resolved_time", off).alias("resolved_ist"),
        to_local("ra_time", off).alias("ra_returned_ist"),
        F.datediff(local_date("ra_time", off), local_date("task_resolved_time", off)).alias("days_after_success"),
    )
