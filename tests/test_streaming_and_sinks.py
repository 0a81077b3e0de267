"""The report, its sink and the job."""

from __future__ import annotations

import tempfile
from datetime import datetime, timezone

from pyspark.sql import functions as F

from ticketflow.config import FIXTURE
from ticketflow.plans import panels, report
from ticketflow.sources.sinks import refresh_stamp, write_panels


def test_refresh_stamp():
    at = datetime(2026, 1, 5, 3, 30, tzinfo=timezone.utc)
    assert refresh_stamp(at) == "2026-01-05 09:00 IST"
    assert refresh_stamp(at, 120) == "2026-01-05 05:30 UTC+02:00"


def test_run_all_and_write(spark, tables):
    out = report.run_all(tables, FIXTURE)
    try:
        assert set(report.ALERT + report.LIVE + report.SCORE + report.SAMPLES) == set(out) - {"assignment_delay"}
        path = tempfile.mkdtemp(prefix="tf-panels-")
        small = {k: out[k] for k in ("assignments", "ra_weekly", "open_ages")}
        counts = write_panels(small, path, FIXTURE.as_of, "2001-08-02 09:00 IST")
        assert counts == {"assignments": 31, "ra_weekly": 5, "open_ages": 4}
        back = spark.read.parquet(f"{path}/ra_weekly")
        assert back.count() == 5 and {"as_of", "last_refresh_ist"} <= set(back.columns)
    finally:
        report.release(tables, FIXTURE)


def test_run_all_orders(spark, tables):
    out = report.run_all(tables, FIXTURE, persist=False)
    ra = [r.age_bucket for r in out["ra_aging"].collect()]
    assert ra == ["0-7 days", "8-14 days", "15-21 days", "22-30 days", "30+ days", "Total"]
    daily = [r.d for r in report.run_all(tables, FIXTURE, persist=False)["daily"].collect()]
    assert daily == sorted(daily) and len(daily) == 121
    newest = [r.resolved_ist for r in report.run_all(tables, FIXTURE, persist=False)["after_success"].collect()]
    assert newest == sorted(newest, reverse=True)
    labels = [r.age_bucket for r in report.run_all(tables, FIXTURE, persist=False)["live_open_ages"].collect()]
    assert labels[-1] == "Total"


def test_job_reads_paths_and_writes_every_panel(spark, tables):
    from ticketflow.job import run_job, source_tables
    base = tempfile.mkdtemp(prefix="tf-src-")
    paths = {}
    for name in ("tasks", "task_performance", "task_logs", "router_user_mapping", "device_audit"):
        df = getattr(tables, name)
        cols = [c for c in df.columns]
        from ticketflow.sources.tables import SCHEMAS
        full = df.select(*[(df[c] if c in cols else F.lit(None).cast(f.dataType)).alias(c)
                           for c, f in ((f.name, f) for f in SCHEMAS[name].fields)])
        full.write.mode("overwrite").parquet(f"{base}/{name}")
        paths[name] = f"{base}/{name}"
    t = source_tables(spark, paths=paths)
    t.ticket_assignments = tables.ticket_assignments
    counts = run_job(t, FIXTURE, tempfile.mkdtemp(prefix="tf-out-"), "2001-08-02 09:00 IST")
    assert counts["summary"] == 16 and counts["assignments"] == 31 and counts["after_success"] == 433


def test_report_with_shared_inputs_equals_plain_panels(spark, tables):
    plain = {k: sorted(tuple(r) for r in df.collect())
             for k, df in report.run_all(tables, FIXTURE, persist=False).items() if k in ("summary", "daily")}
    out = report.run_all(tables, FIXTURE)
    try:
        for k, rows in plain.items():
            assert sorted(tuple(r) for r in out[k].collect()) == rows
    finally:
        report.release(tables, FIXTURE)


def test_bundle_appears_whole_or_not_at_all(spark, tmp_path):
    from datetime import date

    import pytest
    from pyspark.sql import functions as F

    from ticketflow.sources.sinks import bundles, read_bundle, write_bundle
    root = str(tmp_path / "bundle")
    assert bundles(spark, root).count() == 0
    with pytest.raises(FileNotFoundError):
        read_bundle(spark, root)
    first = {"a": spark.range(3), "b": spark.range(5)}
    run = write_bundle(first, root, date(2026, 1, 1), "one")
    # the second panel fails while it is written: the first of the new run is staged, but nobody is told
    broken = {"a": spark.range(30), "b": spark.range(4).select(F.raise_error(F.lit("lost")).alias("id")), "c": spark.range(1)}
    with pytest.raises(Exception, match="lost"):
        write_bundle(broken, root, date(2026, 1, 2), "two")
    got = read_bundle(spark, root)
    assert {n: d.count() for n, d in got.items()} == {"a": 3, "b": 5}
    assert {r.last_refresh_ist for d in got.values() for r in d.collect()} == {"one"}
    again = write_bundle({"a": spark.range(7)}, root, date(2026, 1, 2), "three")
    assert {n: d.count() for n, d in read_bundle(spark, root).items()} == {"a": 7}
    assert {n: d.count() for n, d in read_bundle(spark, root, run).items()} == {"a": 3, "b": 5}
    assert {(r.run, r.panel, r.rows) for r in bundles(spark, root).collect()} == {(run, "a", 3), (run, "b", 5), (again, "a", 7)}
