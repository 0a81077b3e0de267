"""Daily refresh job: read the source tables, build every panel for an as-of
date, write them with a refresh stamp.

    python -m ticketflow.job --as-of 2026-03-02 --out s3://bucket/panels \
        [--tables-prefix db.] [--paths tasks=/data/tasks,...]

Tables are read by catalog name (optionally prefixed) or from explicit paths
with the declared schemas.  The session is whatever the launcher provides;
``session.CLUSTER_CONF`` documents the intended sizing.
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from .config import Config
from .plans import report
from .session import tune
from .sources import tables as T
from .sources.fixtures import Tables
from .sources.sinks import refresh_stamp, write_bundle, write_panels


def source_tables(spark: SparkSession, prefix: str = "", paths: dict[str, str] | None = None,
                  assignments: str | None = None) -> Tables:
    paths = paths or {}

    def get(name: str):
        if name in paths:
            return T.read(spark, name, paths[name])
        return T.by_name(spark, name, prefix)

    assign = spark.table(assignments) if assignments else None
    return Tables(
        tasks=get("tasks"),
        task_performance=get("task_performance"),
        task_logs=get("task_logs"),
        router_user_mapping=get("router_user_mapping"),
        device_audit=get("device_audit"),
        ticket_assignments=assign,
    )


def run_job(t: Tables, cfg: Config, out: str, refreshed_at: str | None = None,
            fmt: str = "parquet", bundle: bool = False) -> dict[str, int] | str:
    """Build and write every panel; returns rows written per panel, or with ``bundle`` (all
    panels of the refresh appear at once) the id of the bundle's run."""
    panels = report.run_all(t, cfg)
    try:
        stamp = refreshed_at or refresh_stamp(offset_minutes=cfg.offset_minutes)
        return (write_bundle if bundle else write_panels)(panels, out, cfg.as_of, stamp, fmt)
    finally:
        report.release(t, cfg)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--as-of", required=True, type=date.fromisoformat)
    ap.add_argument("--out", required=True)
    ap.add_argument("--tables-prefix", default="")
    ap.add_argument("--paths", default="", help="name=path,... for tables read from files")
    ap.add_argument("--cohort-start", type=date.fromisoformat)
    ap.add_argument("--baseline-start", type=date.fromisoformat)
    ap.add_argument("--baseline-end", type=date.fromisoformat)
    ap.add_argument("--assignments", help="catalog name of the ticket assignments; adds the assignment-delay panel")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--bundle", action="store_true", help="stage the panels and commit them together")
    a = ap.parse_args(argv)
    spark = tune(SparkSession.builder.getOrCreate())
    paths = dict(kv.split("=", 1) for kv in a.paths.split(",") if kv)
    cfg = Config(as_of=a.as_of)
    given = {"cohort_start": a.cohort_start, "baseline_start": a.baseline_start, "baseline_end": a.baseline_end}
    cfg = cfg.replace(**{k: v for k, v in given.items() if v})
    done = run_job(source_tables(spark, a.tables_prefix, paths, a.assignments), cfg, a.out, fmt=a.format, bundle=a.bundle)
    if a.bundle:
        print(f"bundle {done}")
    else:
        for name, n in done.items():
            print(f"{name}: {n} rows")


if __name__ == "__main__":
    main()
