
from __future__ import annotations

from pyspark.sql import functions as F

from ticketflow.config import FIXTURE
from ticketflow.plans import panels, summary


def test_success_plus_failed_at_most_total(tables):
    bad = panels.closed_daily(tables, FIXTURE).filter(F.col("success") + F.col("failed") > F.col("total_closed"))
    assert bad.count() == 0


def test_cohort_classes_add_up(tables):
    # status is always 0..3 in the test tables, so the classes partition the cohort
    bad = panels.cohort_status(tables, FIXTURE).filter(
        F.col("success") + F.col("failed") + F.col("open_tickets") != F.col("total_created"))
    assert bad.count() == 0


def test_buckets_add_up_to_open_count(tables):
    lt = panels.latest_tickets(tables, FIXTURE)
    open_n = lt.filter(F.col("status").isin(0, 1)).count()
    assert open_n >= panels.open_age_status(tables, FIXTURE).agg(F.sum("open_tickets")).first()[0] > 0


def test_picked_plus_pending_is_total(tables):
    bad = panels.ra_ageing(tables, FIXTURE).filter(
        F.col("ra_picked") + F.col("still_pending") != F.col("total_failed"))
    assert bad.count() == 0
    total = panels.ra_ageing(tables, FIXTURE).agg(F.sum("total_failed")).first()[0]
    assert total == panels.failed_latest(tables, FIXTURE).count()


def test_one_row_per_key_after_dedupe(tables):
    lt = panels.latest_tickets(tables, FIXTURE)
    assert lt.count() == lt.select("id").distinct().count()


def test_first_rolling_row_equals_daily_rate(tables):
    first = panels.closed_rolling_7(tables, FIXTURE).orderBy("d").first()
    assert first.success_7d == first.success_pct


def test_summary_has_16_rows_in_order(tables):
    rows = summary.weekly_summary(tables, FIXTURE).orderBy("ord").collect()
    assert [r.ord for r in rows] == list(range(1, 17))
    assert rows[0].metric.startswith("Churned") and rows[-1].metric == "RA pending (30+ days)"
