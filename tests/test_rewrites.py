"""The scale rewrites equal the reference's literal join shapes on the test
tables: counted fan-out joins vs the joins themselves, existence vs window."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketflow import config as C
from ticketflow.config import FIXTURE
from ticketflow.functions.buckets import age_bucket
from ticketflow.functions.timeops import age_days, local_date
from ticketflow.operators import filters as P
from ticketflow.operators.joins import inner_fanout, inner_filtered, left_filtered, missing_or
from ticketflow.plans import panels


def _bag(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_open_age_score_equals_left_join_filter(tables):
    t, off = tables, FIXTURE.offset_minutes
    tk = P.eq(t.tasks, "type", C.TICKET_TYPE).filter(P.local_date_between("created", FIXTURE.cohort_start, None, off))
    perf = P.not_deleted(t.task_performance)
    rows = missing_or(tk, perf, "id", "reporterid", F.col("task_resolved_time").isNull())
    b = age_bucket(age_days(local_date("created", off), FIXTURE.as_of), C.OPEN_BUCKETS)
    literal = rows.groupBy(b.alias("age_bucket")).agg(F.count(F.lit(1)).alias("open_tickets"))
    cols = ["age_bucket", "open_tickets"]
    assert _bag(literal, cols) == _bag(panels.open_age_score(t, FIXTURE), cols)


def test_cohort_score_equals_left_join(tables):
    t, off = tables, FIXTURE.offset_minutes
    tk = P.eq(t.tasks, "type", C.TICKET_TYPE).filter(
        P.local_date_between("created", FIXTURE.cohort_start, FIXTURE.as_of, off))
    j = left_filtered(tk, t.task_performance.withColumnRenamed("score", "sc"),
                      tk["id"] == F.col("reporterid"), F.col("_fivetran_deleted") == F.lit(False))
    m = F.trunc(local_date("created", off), "month").alias("month")
    literal = j.groupBy(m).agg(F.count(F.lit(1)).alias("total_created"),
                               F.count_if(F.col("sc") == 1).alias("recovered"),
                               F.count_if(F.col("sc") == 0).alias("failed"),
                               F.count_if(F.col("reporterid").isNull() | F.col("task_resolved_time").isNull())
                               .alias("open_tickets"))
    cols = ["month", "total_created", "recovered", "failed", "open_tickets"]
    assert _bag(literal, cols) == _bag(panels.cohort_score(t, FIXTURE), cols)


def test_missed_daily_equals_fanout_join(tables):
    t, cfg = tables, FIXTURE
    e = panels.eligible_churn(t, cfg).filter(P.date_window("put_expected_date", cfg.as_of, cfg.expected_window_days))
    e = e.join(panels.pickup_locations(t, cfg), e["router_id"] == F.col("nas_id"), "left_anti")
    a = t.device_audit.filter(P.lookback("modified_time", cfg.as_of, cfg.audit_lookback_days))
    from ticketflow.operators.dedupe import latest_per_key
    audit = latest_per_key(a, ["device_id"], panels.audit_order()).select(F.col("nas_id").alias("lng_nas_id"))
    j = inner_fanout(e, audit, e["router_id"] == audit["lng_nas_id"])
    literal = j.groupBy(F.col("put_expected_date").alias("d")).agg(F.count(F.lit(1)).alias("missed_puts"))
    assert _bag(literal, ["d", "missed_puts"]) == _bag(panels.missed_daily(t, cfg), ["d", "missed_puts"])


def test_failed_latest_equals_join_then_window(tables):
    t, cfg, off = tables, FIXTURE, FIXTURE.offset_minutes
    perf = P.not_deleted(t.task_performance).filter(
        F.col("customer_device_id").isNotNull() & P.lookback("task_resolved_time", cfg.as_of, cfg.lookback_days, off))
    tk = t.tasks.filter((F.col("type") == C.TICKET_TYPE) & (F.col("status") == 3))
    j = inner_filtered(tk, t.task_performance, tk["id"] == F.col("reporterid"),
                       (F.col("_fivetran_deleted") == F.lit(False)) & F.col("customer_device_id").isNotNull()
                       & P.lookback("task_resolved_time", cfg.as_of, cfg.lookback_days, off))
    assert j.count() >= perf.join(tk, tk["id"] == perf["reporterid"], "left_semi").count()
    from ticketflow.operators.dedupe import latest_per_key
    order = [F.col("created").desc_nulls_first()] + panels.failed_perf_order()
    lit = latest_per_key(j, ["id"], order).select("id", "customer_device_id",
                                                  local_date("task_resolved_time", off).alias("failed_date"))
    cols = ["id", "customer_device_id", "failed_date"]
    assert _bag(lit, cols) == _bag(panels.failed_latest(t, cfg), cols)
