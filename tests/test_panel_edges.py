"""Panels on hand-made ticket tables: boundaries and NULL cases the driver's
"""

from __future__ import annotations

from datetime import date, datetime

from ticketflow.config import Config
from ticketflow.plans import panels
from ticketflow.sources.fixtures import Tables
from ticketflow.sources.tables import SCHEMAS

AS_OF = date(2025, 12, 20)
CFG = Config(as_of=AS_OF, cohort_start=date(2025, 11, 1))


def ts(s):
    return datetime.fromisoformat(s)


def _tables(spark, tasks=(), perf=(), logs=(), mapping=(), audit=()):
    def df(name, rows):
        return spark.createDataFrame(list(rows), SCHEMAS[name])
    return Tables(tasks=df("tasks", tasks), task_performance=df("task_performance", perf),
                  task_logs=df("task_logs", logs), router_user_mapping=df("router_user_mapping", mapping),
                  device_audit=df("device_audit", audit), ticket_assignments=None)


def task(i, created, status, typ="ROUTER_PICKUP", nas=None):
    extra = None if nas is None else f'{{"nas_id": {nas}}}'
    return (i, None, ts(created) if created else None, None, status, 7, typ, extra)


def perf(i, resolved, restype=None, score=1, device=None, deleted=False, typ="ROUTER_PICKUP"):
    return (i, typ, ts(resolved) if resolved else None, restype, score, device, deleted)


def test_closed_daily_edges(spark):
    t = _tables(spark,
                tasks=[task(1, "2025-12-01 10:00", 2), task(2, "2025-12-01 10:00", 3),
                       task(2, "2025-11-30 10:00", 2)],             # latest version of 2 is the failure
                perf=[perf(1, "2025-12-10 18:29", "ROUTER_RECOVERED"),  # local 2025-12-10 23:59
                      perf(1, "2025-12-10 18:30", None),                # local 2025-12-11 00:00
                      perf(2, "2025-12-10 12:00"),
                      perf(9, "2025-12-10 12:00"),                      # ticket absent from tasks
                      perf(1, "2025-12-10 12:00", deleted=True),
                      perf(1, "2025-12-10 12:00", deleted=None),        # NULL flag dropped too
                      perf(1, None),                                    # unresolved
                      perf(1, "2025-12-10 12:00", typ="INSTALL")])
    got = {r.d: (r.total_closed, r.success, r.failed) for r in panels.closed_daily(t, CFG).collect()}
    assert got == {date(2025, 12, 10): (3, 1, 1), date(2025, 12, 11): (1, 1, 0)}
    res = {r.d: (r.router_recovered, r.general_success) for r in panels.resolution_daily(t, CFG).collect()}
    assert res == {date(2025, 12, 10): (1, 0), date(2025, 12, 11): (0, 1)}   # NULL type is "general"


def test_churn_grace_boundary_is_strict(spark):
    # expire_ist + 15 days < as_of midnight: expiry at local 2025-12-05 00:00 is not yet churned,
    # one second earlier it is.  Raw times are local minus 330 minutes.
    mapping = [(30, "M10", "DONE", 0, 2, ts("2025-11-01 00:00"), ts("2025-12-04 18:30:00")),
               (33, "M11", "DONE", 0, 2, ts("2025-11-01 00:00"), ts("2025-12-04 18:29:59")),
               (36, "M12", "DONE", 0, 1, ts("2025-11-01 00:00"), ts("2025-12-01 00:00")),   # single device
               (39, "M13", "DONE", 0, 2, ts("2025-11-01 00:00"), ts("2025-12-01 00:00")),
               (39, "M13", "DONE", 0, 2, ts("2025-11-20 00:00"), ts("2025-12-10 00:00"))]  # renewed later
    t = _tables(spark, mapping=mapping)
    got = sorted(r.router_id for r in panels.eligible_churn(t, CFG).collect())
    assert got == [33]


def test_missed_daily_counts_devices_at_location_and_skips_pickups(spark):
    mapping = [(30, "M10", "DONE", 0, 2, ts("2025-11-01 00:00"), ts("2025-11-20 00:00")),
               (33, "M11", "DONE", 0, 2, ts("2025-11-01 00:00"), ts("2025-11-20 00:00"))]
    audit = [("DA", 30, ts("2025-12-01 00:00"), None, "{}"), ("DB", 30, ts("2025-12-02 00:00"), None, "{}"),
             ("DC", 33, ts("2025-12-02 00:00"), None, "{}"),
             ("DB", 99, ts("2025-11-30 00:00"), None, "{}")]          # older location of DB ignored
    tasks = [task(5, "2025-12-01 00:00", 0, nas=33)]                  # router 33 got a pickup ticket
    t = _tables(spark, tasks=tasks, mapping=mapping, audit=audit)
    got = {r.d: r.missed_puts for r in panels.missed_daily(t, CFG).collect()}
    assert got == {date(2025, 12, 6): 2}                             # router 30 x two devices


def test_ra_ageing_return_before_failure_counts_and_lco_does_not(spark):
    ra = '{"returnedBy":"RA","router_state":"returned_in_office"}'
    tasks = [task(1, "2025-12-01 00:00", 3), task(2, "2025-12-01 00:00", 3), task(3, "2025-12-01 00:00", 3)]
    perf_rows = [perf(1, "2025-12-10 00:00", device="D1", score=0),
                 perf(2, "2025-12-10 00:00", device="D2", score=0),
                 perf(3, "2025-12-10 00:00", device="D3", score=0)]
    audit = [("D1", 1, ts("2025-12-01 00:00"), None, ra),             # returned before the failure
             ("D2", 1, ts("2025-12-15 00:00"), 77, ra),               # returned via an LCO account
             ("D3", 1, ts("2025-12-15 00:00"), None, '{"returnedBy":"PARTNER"}')]
    t = _tables(spark, tasks=tasks, perf=perf_rows, audit=audit)
    got = {r.age_bucket: (r.total_failed, r.ra_picked, r.still_pending) for r in panels.ra_ageing(t, CFG).collect()}
    assert got == {"8-14 days": (3, 1, 2)}


def test_cohort_pruning_before_the_window_keeps_latest_version_semantics(spark):
    tasks = [task(1, "2025-10-01 00:00", 3), task(1, "2025-11-05 00:00", 0),   # older version before the start
             task(2, "2025-11-05 00:00", 0), task(2, None, 2),                 # NULL created is the latest
             task(3, "2025-10-01 00:00", 0)]                                   # entirely before the start
    t = _tables(spark, tasks=tasks)
    ages = {r.age_bucket: r.open_tickets for r in panels.open_age_status(t, CFG).collect()}
    assert ages == {"21+ days": 1}
    m = [(r.month, r.total_created, r.open_tickets) for r in panels.cohort_status(t, CFG).collect()]
    assert m == [(date(2025, 11, 1), 1, 1)]


def test_after_success_rows(spark, tables):
    from ticketflow.config import FIXTURE
    assert panels.returned_after_success(tables, FIXTURE).count() == 433
