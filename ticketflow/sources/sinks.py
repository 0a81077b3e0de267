"""Writing panels out.

Each panel is written as its own dataset with the as-of date and refresh
stamp as columns.  Row counts come from an ``Observation`` attached to the
write itself, so counting costs no second job.

A refresh that readers must see as a whole is a bundle: every panel goes to a
folder of the run's own, and only then one manifest file is added that names the
run.  Readers follow the latest manifest, so a refresh that fails at any panel,
or is still under way, leaves the bundle before it in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import date, datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def refresh_stamp(now: datetime | None = None, offset_minutes: int = 330) -> str:
    """Local refresh time as 'yyyy-MM-dd HH:mm IST'; offsets other than that zone's
    are named by themselves ('UTC+02:00')."""
    now = now or datetime.now(timezone.utc)
    if now.tzinfo is None:
        now = now.replace(tzinfo=timezone.utc)
    local = now.astimezone(timezone(timedelta(minutes=offset_minutes)))
    zone = "IST" if offset_minutes == 330 else f"UTC{local.strftime('%z')[:3]}:{local.strftime('%z')[3:]}"
    return f"{local:%Y-%m-%d %H:%M} {zone}"


def with_row_count(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that fills in when ``df`` is next acted on."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_panels(panels: Mapping[str, DataFrame], path: str, as_of: date, refreshed_at: str,
                 fmt: str = "parquet", mode: str = "overwrite") -> dict[str, int]:
    """Write every panel to ``path/<name>``; returns rows written per panel."""
    counts: dict[str, int] = {}
    for name, df in panels.items():
        out = df.withColumn("as_of", F.lit(as_of)).withColumn("last_refresh_ist", F.lit(refreshed_at))
        out, obs = with_row_count(out, name)
        out.write.mode(mode).format(fmt).save(f"{path.rstrip('/')}/{name}")
        counts[name] = int(obs.get["rows"])
    return counts


_MANIFEST = "run string, committed_at timestamp, as_of date, refreshed_at string, fmt string, panel string, rows long"


def write_bundle(panels: Mapping[str, DataFrame], root: str, as_of: date, refreshed_at: str, fmt: str = "parquet") -> str:
    """Write all panels as one bundle under ``root`` and return the run's id.

    Panels are staged in ``root/runs/<run>/<name>``; the manifest is one file
    with a row for each panel, which appears by the rename of the write's commit.
    """
    run = f"{as_of:%Y%m%d}-{uuid.uuid4().hex}"
    counts = write_panels(panels, f"{root.rstrip('/')}/runs/{run}", as_of, refreshed_at, fmt, mode="errorifexists")
    spark = next(iter(panels.values())).sparkSession
    now = datetime.now(timezone.utc)
    rows = [(run, now, as_of, refreshed_at, fmt, name, n) for name, n in counts.items()]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/manifest")
    return run


def bundles(spark: SparkSession, root: str) -> DataFrame:
    """The committed bundles: a row for each run and panel, none before the first commit."""
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{root.rstrip('/')}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)


def read_bundle(spark: SparkSession, root: str, run: str | None = None) -> dict[str, DataFrame]:
    """Panels by name of the bundle committed last, or of ``run``.  All come from one run."""
    all_runs = bundles(spark, root)
    if run is None:
        last = all_runs.orderBy(F.desc("committed_at"), F.desc("run")).first()
        if last is None:
            raise FileNotFoundError(f"no bundle has been committed under {root}")
        run = last.run
    rows = all_runs.where(F.col("run") == run).collect()  # one row a panel
    if not rows:
        raise FileNotFoundError(f"no bundle {run} has been committed under {root}")
    return {r.panel: spark.read.format(r.fmt).load(f"{root.rstrip('/')}/runs/{run}/{r.panel}") for r in rows}
