"""Whole refreshes: the alert job's panels plus the live and score jobs'.

``run_all`` returns lazy DataFrames keyed by the payload names the reference
uses; the inputs several panels share (latest versions of tickets created
since the cohort start, per-day closures, failed tickets) and the small
per-day / per-bucket panels the weekly summary reads again are persisted
once for the refresh and released by ``release``.  A lost executor only means those blocks are rebuilt from their
short lineage (one scan and one window each).
"""

from __future__ import annotations

from datetime import timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from .. import config as C
from ..config import Config
from ..functions.buckets import bucket_rank
from ..operators import sorts
from ..sources.fixtures import Tables
from . import panels, summary

ALERT = ("missed_puts", "assignments", "daily", "mom", "open_ages", "ra_aging", "ra_weekly", "summary")
SAMPLES = ("after_success", "unreadable")
LIVE = ("live_mom", "live_daily", "live_open_ages")
SCORE = ("score_mom", "score_daily", "score_open_ages")


def shared_inputs(t: Tables, cfg: Config) -> list[DataFrame]:
    lo = cfg.as_of - timedelta(days=cfg.lookback_days)
    return [
        # inputs of several panels
        panels.latest_tickets(t, cfg, ("id", "created", "status"), cfg.cohort_start),
        panels.closed_outcomes_daily(t, cfg, lo, cfg.as_of),
        summary.daily_outcomes(t, cfg),
        panels.failed_latest(t, cfg),
        # small per-day / per-bucket panels the weekly summary reads again
        panels.missed_daily(t, cfg),
        panels.assigned_daily(t, cfg),
        panels.open_age_status(t, cfg),
        panels.ra_ageing(t, cfg),
    ]


def run_all(t: Tables, cfg: Config, persist: bool = True) -> dict[str, DataFrame]:
    """Every panel of the three jobs, each ordered for display (by period or
    bucket rank)."""
    if persist:
        for df in shared_inputs(t, cfg):
            df.persist(StorageLevel.MEMORY_AND_DISK)

    def by(df: DataFrame, col: str) -> DataFrame:
        return sorts.by_period(df, col)

    def ranked(df: DataFrame, buckets) -> DataFrame:
        return sorts.by_bucket(df, bucket_rank("age_bucket", buckets + (("Total", None, None),)))

    out = {
        # alert job
        "missed_puts": by(panels.missed_daily(t, cfg), "d"),
        "assignments": by(panels.assigned_daily(t, cfg), "d"),
        "daily": by(panels.closed_rolling_7(t, cfg), "d"),
        "mom": by(panels.cohort_status_rates(t, cfg), "month"),
        "open_ages": ranked(summary.open_age_signals(t, cfg), C.OPEN_BUCKETS),
        "ra_aging": ranked(summary.ra_ageing_total(t, cfg), C.RA_BUCKETS),
        "ra_weekly": by(panels.ra_weekly(t, cfg), "week_start"),
        "summary": sorts.by_period(summary.weekly_summary(t, cfg), "ord"),
        # live job (status based)
        "live_mom": by(panels.cohort_status_live(t, cfg), "month"),
        "live_daily": by(panels.closed_daily_since_start(t, cfg), "resolved_date"),
        "live_open_ages": ranked(summary.open_age_total(t, cfg), C.OPEN_BUCKETS),
        # first version (score based)
        "score_mom": by(panels.cohort_score_rates(t, cfg), "month"),
        "score_daily": by(panels.closed_rolling_7_score(t, cfg), "resolved_date"),
        "score_open_ages": ranked(panels.open_age_score(t, cfg), C.OPEN_BUCKETS),
        # tickets whose location cannot be read, so that their customers count as missed
        "unreadable": panels.unreadable_locations(t, cfg),
        # returned after success: newest resolution first, as in the sample
        "after_success": sorts.newest_first(panels.returned_after_success(t, cfg), "resolved_ist",
                                            ["task_id", "ra_returned_ist"]),
    }
    if t.ticket_assignments is not None:
        out["assignment_delay"] = panels.assignment_delay(t, cfg)
    return out


def release(t: Tables, cfg: Config) -> None:
    for df in shared_inputs(t, cfg):
        df.unpersist()
