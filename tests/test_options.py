"""Options beside the parity forms, and hot keys of the plans that changed with them."""

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from ticketflow.operators.sorts import numbered
from ticketflow.operators.windows import next_event, rolling_sums


def test_calendar_frame_counts_days_not_rows(spark):
    df = spark.createDataFrame([(date(2025, 1, 1), 1), (date(2025, 1, 2), 2), (date(2025, 1, 8), 4), (date(2025, 1, 20), 8)],
                               "d date, n long")
    rows = {r.d.day: r.n_roll for r in rolling_sums(df, "d", ["n"], 7).collect()}
    days = {r.d.day: r.n_roll for r in rolling_sums(df, "d", ["n"], 7, calendar=True).collect()}
    assert rows == {1: 1, 2: 3, 8: 7, 20: 15}
    assert days == {1: 1, 2: 3, 8: 6, 20: 8}


def test_next_event_is_lead_over_the_whole_key(spark):
    base = datetime(2025, 3, 1)
    rows = [(i, None if i % 11 == 0 else f"k{i % 3}", None if i % 13 == 0 else base + timedelta(seconds=(i * 37) % 900))
            for i in range(300)]
    df = spark.createDataFrame(rows, "i long, k string, t timestamp_ntz")
    got = {r.i: r.nx for r in next_event(df, "k", "t", ["i"], "nx").collect()}
    want = {}
    for key in {k for _, k, _ in rows}:
        own = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2] is None, r[2] or base, r[0]))
        want |= {a[0]: b[2] for a, b in zip(own, [*own[1:], (None, None, None)])}
    assert got == want


def test_numbered_rows(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "x string")
    got = {r.x: r.position for r in numbered(df, F.col("x").asc_nulls_last()).collect()}
    assert got == {"a": 1, "b": 2, None: 3}


def test_return_before_the_failure_is_pending_with_require_after(spark, tables):
    from ticketflow.config import FIXTURE
    from ticketflow.plans import panels
    any_time = {r.age_bucket: r for r in panels.ra_ageing(tables, FIXTURE).collect()}
    after = {r.age_bucket: r for r in panels.ra_ageing_after(tables, FIXTURE).collect()}
    assert any_time.keys() == after.keys()
    for k, r in after.items():
        assert r.total_failed == any_time[k].total_failed == r.ra_picked + r.still_pending
        assert r.ra_picked <= any_time[k].ra_picked


def test_score_panels_count_ticket_versions_before_the_join(spark, tables):
    from ticketflow.config import FIXTURE
    from ticketflow.plans import panels
    for df in (panels.cohort_score(tables, FIXTURE), panels.open_age_score(tables, FIXTURE)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        join = plan.index("Join LeftOuter")
        assert plan[join:].count("Aggregate") >= 2  # both sides of the join
