"""Weekly roll-ups, baselines, trends, signals and the 16-row weekly summary.

All of it is computed from the per-day / per-bucket panels inside the plan;
the only driver-side values are the as-of date and the week boundaries it
implies.  The panels are tiny (one row per day, week or bucket), so the
summary's unions and pivots cost nothing next to the scans beneath them.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import Config
from ..functions import alerts
from ..functions.rates import pct, round_even
from ..operators import weekly as W
from ..operators.agg import bucket_total, with_total, zero_fill
from ..sources.fixtures import Tables
from . import panels
from .panels import shared

# (key, caption, numerator column of the daily outcome panel, higher is good)
RATIO_METRICS = (
    ("success", C.M_SUCCESS, "success", True),
    ("router", C.M_ROUTER, "router_recovered", True),
    ("customer", C.M_CUSTOMER, "customer_recovered", True),
    ("general", C.M_GENERAL, "general_success", False),
    ("failed", C.M_FAILED, "failed", False),
)


def _spark(t: Tables) -> SparkSession:
    return t.tasks.sparkSession


@shared
def weeks(t: Tables, cfg: Config) -> DataFrame:
    return W.week_frame(_spark(t), cfg.as_of, cfg.n_weeks)


@shared
def daily_outcomes(t: Tables, cfg: Config) -> DataFrame:
    """Closures per day over the weeks and the whole baseline, however old it is."""
    lo = min(cfg.as_of - timedelta(days=cfg.lookback_days), cfg.baseline_start)
    return panels.closed_outcomes_daily(t, cfg, lo, cfg.as_of)


@shared
def ratio_daily_long(t: Tables, cfg: Config) -> DataFrame:
    """(metric, d, num, den): one row per day and ratio metric."""
    d = daily_outcomes(t, cfg)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(key).alias("metric"), F.col(col).alias("num")) for key, _, col, _ in RATIO_METRICS]))
    return d.select("d", F.col("total_closed").alias("den"), stacked.alias("m")) \
        .select("m.metric", "d", "m.num", "den")


# ---------------------------------------------------------------- weekly panels

@shared
def weekly_avg_assigned(t: Tables, cfg: Config) -> DataFrame:
    """Mean assignments per day present, per ISO week."""
    return W.avg_per_day(panels.assigned_daily(t, cfg), "d", "assigned", "avg_assigned")


@shared
def weekly_ratios(t: Tables, cfg: Config) -> DataFrame:
    """Per ISO week, every ratio metric as its own column (one aggregate)."""
    lo = cfg.as_of - timedelta(days=cfg.lookback_days)
    d = W.by_week(panels.closed_outcomes_daily(t, cfg, lo, cfg.as_of), "d")
    sums = [F.sum(col).alias(f"_{key}") for key, _, col, _ in RATIO_METRICS]
    agg = d.groupBy("week_start").agg(F.sum("total_closed").alias("_den"), *sums)
    return agg.select("week_start", *[pct(f"_{key}", "_den").alias(f"{key}_pct")
                                      for key, _, _, _ in RATIO_METRICS])


@shared
def weekly_ra_total(t: Tables, cfg: Config) -> DataFrame:
    """RA returns in each of the last complete weeks (NULL if none)."""
    wk = weeks(t, cfg)
    ra = panels.ra_weekly(t, cfg)
    return W.total(wk.join(ra, "week_start", "left"), ["slot", "week_start"], "ra_returns", "ra_returns")


@shared
def baseline_avg(t: Tables, cfg: Config) -> DataFrame:
    """Assignments per day over the baseline range."""
    daily = panels.assigned_between(t, cfg, cfg.baseline_start, cfg.baseline_end)
    b = W.baseline_avg(daily, "d", "assigned", cfg.baseline_start, cfg.baseline_end)
    return b.select(F.lit(C.M_ASSIGNED).alias("metric"), "baseline")


@shared
def baseline_ratio(t: Tables, cfg: Config) -> DataFrame:
    """Every ratio metric over the baseline range (one row per metric)."""
    long = ratio_daily_long(t, cfg).filter(
        F.col("d").between(F.lit(cfg.baseline_start), F.lit(cfg.baseline_end)))
    names = F.create_map(*[x for key, cap, _, _ in RATIO_METRICS for x in (F.lit(key), F.lit(cap))])
    agg = long.groupBy("metric").agg(F.sum("num").alias("_n"), F.sum("den").alias("_d"))
    present = agg.select(names[F.col("metric")].alias("metric"), pct("_n", "_d").alias("baseline"))
    # Metrics with no baseline day at all still get a row (NULL baseline).
    every = _spark(t).createDataFrame([(cap,) for _, cap, _, _ in RATIO_METRICS], "metric string")
    return every.join(present, "metric", "left")


@shared
def baseline_from_panel(t: Tables, cfg: Config) -> DataFrame:
    """G14 and G15 as the reference takes them: from the daily panels, which reach ``lookback_days`` back,
    so that a baseline older than that loses its first days and in the end all of them."""
    lo = cfg.as_of - timedelta(days=cfg.lookback_days)
    assigned = W.baseline_avg(panels.assigned_daily(t, cfg), "d", "assigned", cfg.baseline_start, cfg.baseline_end)
    days = panels.closed_outcomes_daily(t, cfg, lo, cfg.as_of).filter(
        F.col("d").between(F.lit(cfg.baseline_start), F.lit(cfg.baseline_end)))
    sums = days.agg(F.sum("total_closed").alias("_den"), *[F.sum(col).alias(col) for _, _, col, _ in RATIO_METRICS])
    ratios = sums.select("_den", F.explode(F.array(*[
        F.struct(F.lit(cap).alias("metric"), F.col(col).alias("num")) for _, cap, col, _ in RATIO_METRICS])).alias("m"))
    return assigned.select(F.lit(C.M_ASSIGNED).alias("metric"), "baseline").unionByName(
        ratios.select("m.metric", pct("m.num", "_den").alias("baseline")))


# ---------------------------------------------------------------- three-week rows

def _avg_row(daily: DataFrame, value: str, cfg: Config, with_baseline: bool) -> DataFrame:
    """One row: weekly means of ``value`` over the days present (0 decimals,
    half-even) for W-n..W-1 and, optionally, over the baseline range."""
    base = (cfg.baseline_start, cfg.baseline_end) if with_baseline else None
    per = W.slot_sums(daily, "d", [value], cfg.as_of, cfg.n_weeks, base)
    mean = round_even(F.col(value) / F.col("_days"), 0)
    return per.agg(*W.by_slot(per, mean, cfg.n_weeks, with_baseline))


@shared
def ratio_week_rows(t: Tables, cfg: Config) -> DataFrame:
    """(metric caption, w3, w2, w1, baseline, higher_is_good) per ratio metric,
    from one aggregate of the per-day closures by week slot.  The sums are
    unfolded to a row per metric before the rates are taken, so the plan holds
    one rate per slot, not one per slot and metric."""
    nums = [col for _, _, col, _ in RATIO_METRICS]
    per = W.slot_sums(daily_outcomes(t, cfg), "d", nums + ["total_closed"], cfg.as_of, cfg.n_weeks,
                      (cfg.baseline_start, cfg.baseline_end))
    names = [f"w{k}" for k in range(cfg.n_weeks, 0, -1)] + ["baseline"]
    wide = per.agg(*[agg.alias(f"{col}__{name}") for col in nums + ["total_closed"]
                     for agg, name in zip(W.by_slot(per, F.col(col), cfg.n_weeks), names)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(cap).alias("metric"), F.lit(hig).alias("higher_is_good"), F.lit(i).alias("_i"),
                 *[F.col(f"{col}__{name}").alias(f"_{name}") for name in names])
        for i, (_, cap, col, hig) in enumerate(RATIO_METRICS)]))
    long = wide.select(rows.alias("r"), *[f"total_closed__{name}" for name in names]).select("r.*", *[
        f"total_closed__{name}" for name in names])
    return long.select("metric", "higher_is_good", "_i",
                       *[pct(f"_{name}", f"total_closed__{name}").alias(name) for name in names])


@shared
def week_rows(t: Tables, cfg: Config) -> DataFrame:
    """All weekly metrics as (metric, w3, w2, w1, baseline, higher_is_good)."""
    cols = ["metric", "w3", "w2", "w1", "baseline", "higher_is_good", "_i"]
    # No baseline for missed pickups (its panel only reaches 60 days back).
    missed = _avg_row(panels.missed_daily(t, cfg), "missed_puts", cfg, False).select(
        F.lit(C.M_MISSED).alias("metric"), "w3", "w2", "w1",
        F.lit(None).cast("double").alias("baseline"), F.lit(False).alias("higher_is_good"),
        F.lit(-2).alias("_i"))
    lo = min(cfg.as_of - timedelta(days=cfg.lookback_days), cfg.baseline_start)
    assigned = _avg_row(panels.assigned_between(t, cfg, lo, cfg.as_of), "assigned", cfg, True).select(
        F.lit(C.M_ASSIGNED).alias("metric"), "w3", "w2", "w1", "baseline",
        F.lit(True).alias("higher_is_good"), F.lit(-1).alias("_i"))
    ratios = ratio_week_rows(t, cfg).select(*cols)
    return missed.select(*cols).unionByName(assigned.select(*cols)).unionByName(ratios)


@shared
def trend(t: Tables, cfg: Config) -> DataFrame:
    """A1 for every weekly metric."""
    r = week_rows(t, cfg)
    text, direction = alerts.trend(["w3", "w2", "w1"])
    return r.select("metric", "w3", "w2", "w1", text.alias("trend"), direction.alias("trend_dir"))


@shared
def vs_baseline(t: Tables, cfg: Config) -> DataFrame:
    """A2 for every weekly metric that has a baseline."""
    r = week_rows(t, cfg).filter(F.col("metric") != C.M_MISSED)
    text, direction = alerts.vs_baseline("w1", "baseline", F.col("higher_is_good"))
    return r.select("metric", "w1", "baseline", text.alias("vs_bl"), direction.alias("vs_dir"))


# ---------------------------------------------------------------- bucket snapshots

@shared
def open_age_signals(t: Tables, cfg: Config) -> DataFrame:
    """Every open-age bucket (0 when empty) with its threshold signal."""
    z = zero_fill(panels.open_age_status(t, cfg), C.OPEN_BUCKETS, ["open_tickets"])
    return z.select("age_bucket", "bucket_rank", "open_tickets",
                    alerts.threshold_signal("age_bucket", "open_tickets", C.OPEN_SIGNAL_RULES).alias("signal"))


@shared
def ra_ageing_pct(t: Tables, cfg: Config) -> DataFrame:
    """Every RA bucket (0 when empty) with pickup % rounded half-even."""
    z = zero_fill(panels.ra_ageing(t, cfg), C.RA_BUCKETS, ["total_failed", "ra_picked", "still_pending"])
    total = F.col("ra_picked") + F.col("still_pending")
    return z.select("age_bucket", "bucket_rank", "total_failed", "ra_picked", "still_pending",
                    pct("ra_picked", total, 0).alias("pickup_pct"))


@shared
def ra_signals(t: Tables, cfg: Config) -> DataFrame:
    """A7 + A8: pending threshold signal and pickup verdict per RA bucket."""
    r = ra_ageing_pct(t, cfg)
    text, direction = alerts.pickup_verdict("pickup_pct")
    return r.select("age_bucket", "bucket_rank", "still_pending", "ra_picked", "pickup_pct",
                    text.alias("vs_bl"), direction.alias("vs_dir"),
                    alerts.threshold_signal("age_bucket", "still_pending", C.RA_SIGNAL_RULES).alias("signal"))


@shared
def ra_ageing_total(t: Tables, cfg: Config) -> DataFrame:
    """G19 for the RA table: buckets plus a Total row, pickup % rounded half-up
    from the summed counts (the page's table)."""
    z = zero_fill(panels.ra_ageing(t, cfg), C.RA_BUCKETS, ["total_failed", "ra_picked", "still_pending"])
    tot = with_total(z, "age_bucket", ["total_failed", "ra_picked", "still_pending"])
    return tot.withColumn("pickup_pct", pct("ra_picked", "total_failed", 0, half_up=True))


@shared
def open_age_total(t: Tables, cfg: Config) -> DataFrame:
    """G19 for the open-age table: buckets present plus a Total row."""
    return with_total(panels.open_age_status(t, cfg), "age_bucket", ["open_tickets"])


@shared
def danger_total(t: Tables, cfg: Config) -> DataFrame:
    """Open tickets older than 14 days (the 15-21 and 21+ buckets)."""
    return bucket_total(panels.open_age_status(t, cfg), "age_bucket",
                        [C.OPEN_BUCKETS[2][0], C.OPEN_BUCKETS[3][0]], "open_tickets", "danger_total")


@shared
def pickup_totals(t: Tables, cfg: Config) -> DataFrame:
    """RA pending, picked, total and pickup % over all buckets."""
    r = panels.ra_ageing(t, cfg)
    s = r.agg(F.coalesce(F.sum("still_pending"), F.lit(0)).cast("bigint").alias("pending"),
              F.coalesce(F.sum("ra_picked"), F.lit(0)).cast("bigint").alias("picked"))
    return s.select("pending", "picked", (F.col("pending") + F.col("picked")).alias("total"),
                    pct("picked", F.col("pending") + F.col("picked"), 1).alias("pickup_pct"))


# ---------------------------------------------------------------- the summary

SUMMARY_COLUMNS = ["ord", "metric", "type", "sub", "w3", "w2", "w1", "trend", "trend_dir",
                   "baseline", "vs_bl", "vs_dir", "signal", "fmt"]


@shared
def weekly_summary(t: Tables, cfg: Config) -> DataFrame:
    """The 16-row weekly signal table, in display order (``ord``)."""
    r = week_rows(t, cfg)
    tr_text, tr_dir = alerts.trend(["w3", "w2", "w1"])
    vs_text, vs_dir = alerts.vs_baseline("w1", "baseline", F.col("higher_is_good"))
    m = F.col("metric")
    is_missed, is_assigned = m == C.M_MISSED, m == C.M_ASSIGNED
    is_sub = m.isin(C.M_ROUTER, C.M_CUSTOMER, C.M_GENERAL)
    wk = (r.withColumn("trend", tr_text).withColumn("trend_dir", tr_dir)
          .withColumn("vs_bl", F.when(is_missed, "-").otherwise(vs_text))
          .withColumn("vs_dir", F.when(is_missed, "neutral").otherwise(vs_dir)))
    wk = wk.select(
        F.when(is_missed, 1).when(is_assigned, 2).when(m == C.M_SUCCESS, 3)
         .when(m == C.M_ROUTER, 4).when(m == C.M_CUSTOMER, 5).when(m == C.M_GENERAL, 6)
         .otherwise(11).alias("ord"),
        "metric",
        F.when(is_sub, "").when(is_assigned, "Leading").otherwise("Lagging").alias("type"),
        is_sub.alias("sub"),
        "w3", "w2", "w1", "trend", "trend_dir", "baseline", "vs_bl", "vs_dir",
        F.when(is_missed, alerts.signal_from_trend("trend_dir", "bad"))
         .when(is_assigned, alerts.signal_from_trend("trend_dir", "good"))
         .when(is_sub, "neutral")
         .otherwise(alerts.signal_from_baseline("vs_dir")).alias("signal"),
        F.when(is_missed | is_assigned, "int").otherwise("pct").alias("fmt"),
    )
    none_d = F.lit(None).cast("double")
    opens = open_age_signals(t, cfg).select(
        (F.col("bucket_rank") + 6).alias("ord"),
        F.format_string("Open tickets (%s)", "age_bucket").alias("metric"),
        F.lit("Leading").alias("type"), F.lit(False).alias("sub"),
        none_d.alias("w3"), none_d.alias("w2"), F.col("open_tickets").cast("double").alias("w1"),
        F.lit("-").alias("trend"), F.lit("neutral").alias("trend_dir"), none_d.alias("baseline"),
        F.lit("-").alias("vs_bl"), F.lit("neutral").alias("vs_dir"), "signal", F.lit("int").alias("fmt"))
    ras = ra_signals(t, cfg).select(
        (F.col("bucket_rank") + 11).alias("ord"),
        F.format_string("RA pending (%s)", "age_bucket").alias("metric"),
        F.lit("Lagging").alias("type"), F.lit(False).alias("sub"),
        none_d.alias("w3"), none_d.alias("w2"), F.col("still_pending").cast("double").alias("w1"),
        F.lit("-").alias("trend"), F.lit("neutral").alias("trend_dir"), none_d.alias("baseline"),
        "vs_bl", "vs_dir", "signal", F.lit("int").alias("fmt"))
    out = wk.select(*SUMMARY_COLUMNS).unionByName(opens.select(*SUMMARY_COLUMNS)) \
        .unionByName(ras.select(*SUMMARY_COLUMNS))
    return out.withColumn("ord", F.col("ord").cast("int"))
