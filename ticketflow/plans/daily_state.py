"""Stored daily counts that a refresh brings up to date day by day.

The weekly layer, the rolling rates and the baselines all read closures and
assignments per local day.  Their counts of a day change only when rows of that
day arrive late, or when a ticket closed on it gets another version.  So the counts are
stored per day; a refresh names the days its new rows touch, counts those days
again from the facts and adds their rows under a run number of its own, and no
other day's facts are read.  A day's counts are those of its latest run.

A refresh adds one small file, which appears by the rename of the write's commit:
readers see all of a refresh or none of it, and one that fails leaves the state as it was.
One writer at a time.  (A folder for each day, replaced in place, took 57 s for 2,142 days
on a local disk, and a failure would leave some days old and some new.)

Counting a day again, rather than adding to it, is what makes late versions
right (a ticket's outcome moves its past closures from one class to another) and lets
a refresh that was cut off simply be repeated.

What a refresh gets as new rows: performance rows and log rows as they are now, and also
as they were where a time or a deletion mark was changed (their old day is
touched too); ticket versions as they are added.  Rows without a time or
key touch no day.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import Config
from ..functions.timeops import local_date
from ..operators import filters as P
from ..operators.joins import only_keys_of
from ..sources.fixtures import Tables
from . import panels

CLOSURES = ("total_closed", "success", "failed", "router_recovered", "customer_recovered", "general_success")
ASSIGNED = ("assigned",)


def _days(rows: DataFrame) -> list[date]:
    """The distinct days of ``rows``: one value for each calendar day of the history at most."""
    return sorted(r.d for r in rows.filter(F.col("d").isNotNull()).distinct().collect())


def closure_days(t: Tables, cfg: Config, performance: DataFrame | None = None,
                 versions: DataFrame | None = None) -> list[date]:
    """Local days whose closures new ``performance`` rows or new ticket ``versions`` can change."""
    off = cfg.offset_minutes
    touched = []
    if performance is not None:
        p = P.eq(performance, "task_type", C.TICKET_TYPE)
        touched.append(p.select(local_date("task_resolved_time", off).alias("d")))
    if versions is not None:
        ids = P.eq(versions, "type", C.TICKET_TYPE).select("id").distinct()
        # rows are dropped in the scan's tasks and reduced to (ticket, day) there before they meet the ids
        closed = only_keys_of(panels.live_performance(t).filter(F.col("task_resolved_time").isNotNull()), "reporterid", ids, "id") \
            .select("reporterid", local_date("task_resolved_time", off).alias("d")).distinct()
        touched.append(closed.join(ids, closed["reporterid"] == ids["id"], "left_semi").select("d"))
    if not touched:
        return []
    return _days(touched[0] if len(touched) == 1 else touched[0].unionByName(touched[1]))


def assigned_days(cfg: Config, logs: DataFrame) -> list[date]:
    """Local days whose assignments new ``logs`` rows can change."""
    return _days(P.eq(logs, "event_name", C.ASSIGN_EVENT).select(local_date("added_time", cfg.offset_minutes).alias("d")))


def _schema(measures: Sequence[str]) -> str:
    return "run bigint, d date, " + ", ".join(f"{m} bigint" for m in measures)


def _stored(spark: SparkSession, path: str, measures: Sequence[str]) -> DataFrame:
    """All runs' rows; none before the first refresh."""
    try:
        return spark.read.schema(_schema(measures)).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _schema(measures))


def replace_days(spark: SparkSession, path: str, daily: DataFrame, days: Sequence[date], measures: Sequence[str]) -> int:
    """Add a run with the rows that ``days`` have in ``daily``, zeros for a day without any; returns its number."""
    last = _stored(spark, path, measures).agg(F.max("run")).first()[0]
    run = 0 if last is None else last + 1
    zeros = spark.createDataFrame([(d,) for d in days], "d date").select("d", *[F.lit(0).cast("bigint").alias(m) for m in measures])
    rows = daily.select("d", *measures).unionByName(zeros).groupBy("d") \
        .agg(*[F.sum(F.coalesce(F.col(m), F.lit(0))).cast("bigint").alias(m) for m in measures])
    # a row for each day, so one file; the counts behind it keep their own partitions
    rows.select(F.lit(run).cast("bigint").alias("run"), "d", *measures).repartition(1).write.mode("append").parquet(path)
    return run


def refresh_closures(t: Tables, cfg: Config, path: str, performance: DataFrame | None = None,
                     versions: DataFrame | None = None) -> list[date]:
    """Bring the closures stored at ``path`` up to date with ``t``, which already holds the new rows.
    Returns the days counted again.  Without new rows given, every day is (the first build)."""
    if performance is None and versions is None:
        performance = t.task_performance
    days = closure_days(t, cfg, performance, versions)
    if days:
        replace_days(t.tasks.sparkSession, path, panels.closures_on(t, cfg, days), days, CLOSURES)
    return days


def refresh_assigned(t: Tables, cfg: Config, path: str, logs: DataFrame | None = None) -> list[date]:
    """``refresh_closures`` for assignments per day."""
    days = assigned_days(cfg, t.task_logs if logs is None else logs)
    if days:
        replace_days(t.tasks.sparkSession, path, panels.assigned_on(t, cfg, days), days, ASSIGNED)
    return days


def read_days(spark: SparkSession, path: str, measures: Sequence[str]) -> DataFrame:
    """Each stored day as its latest run counted it; days without rows are left out."""
    now = _stored(spark, path, measures).groupBy("d").agg(F.max(F.struct("run", *measures)).alias("_m")).select("d", "_m.*").drop("run")
    return now.filter(F.greatest(*[F.col(m) for m in measures], F.lit(0)) > 0)


def with_state(t: Tables, closures: str | None = None, assigned: str | None = None) -> Tables:
    """``t`` whose closures and assignments per day come from the stored counts, so that the daily, rolling,
    weekly and baseline panels read days instead of facts."""
    spark = t.tasks.sparkSession
    return replace(t, memo={},
                   closures=read_days(spark, closures, CLOSURES) if closures else None,
                   assigned=read_days(spark, assigned, ASSIGNED) if assigned else None)
