"""Window operators: next event per key, last event per key, trailing row frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import next_times


def next_event(df: DataFrame, key: str, ts: str, tie_cols: Sequence[str] = (), out: str = "next_ts") -> DataFrame:
    """LEAD(ts) OVER (PARTITION BY key ORDER BY ts, tie_cols ASC NULLS LAST).
    NULL means the row is the key's last (or the next row has no time).

    Of the rows of one (key, instant) all but the last are followed by that
    instant, and the last by the key's next one, which ``joins.next_times`` finds
    for the distinct instants.  So a hot key is spread over its instants; rows
    without a time need no window."""
    timed = df.filter(F.col(ts).isNotNull()).withColumn("_k", F.col(key)).withColumn("_t", F.col(ts))
    after = next_times(timed.groupBy("_k", "_t").agg(F.max("_t").alias("_r"))).select(
        F.col("_k").alias("_ak"), F.col("_t").alias("_at"), F.col("_next").alias("_an"))
    w = Window.partitionBy("_k", "_t").orderBy(*[F.col(c).desc_nulls_first() for c in tie_cols] or [F.lit(1)])
    res = timed.withColumn("_rn", F.row_number().over(w)).join(
        after, F.col("_k").eqNullSafe(F.col("_ak")) & (F.col("_t") == F.col("_at")), "left")
    res = res.withColumn(out, F.when(F.col("_rn") == 1, F.col("_an")).otherwise(F.col("_t"))) \
        .drop("_k", "_t", "_ak", "_at", "_rn", "_an")
    untimed = df.filter(F.col(ts).isNull())
    return res.unionByName(untimed.withColumn(out, F.col(ts)))


def last_events(df: DataFrame, key: str, ts: str, tie_cols: Sequence[str] = ()) -> DataFrame:
    """Rows whose LEAD(ts) under ``next_event``'s order would be NULL, without
    sorting a whole key into one task.

    Under ``ts ASC NULLS LAST, tie_cols ASC NULLS LAST`` the lead of a row is
    NULL exactly when the row has a NULL time (every later row has one too) or
    it is the last non-NULL row of its key.  The latter is a top-1 per key
    (partial + final WindowGroupLimit), so a hot key is cut down map-side.
    """
    order = [F.col(ts).desc_nulls_last()] + [F.col(c).desc_nulls_first() for c in tie_cols]
    w = Window.partitionBy(key).orderBy(*order)
    top = (df.filter(F.col(ts).isNotNull())
           .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn"))
    return top.unionByName(df.filter(F.col(ts).isNull()))


def rolling_sums(df: DataFrame, order: str, cols: Sequence[str], rows: int = 7,
                 by: Sequence[str] = (), suffix: str = "_roll", calendar: bool = False) -> DataFrame:
    """Trailing frame of ``rows`` rows (rows-1 before + current), shorter at the
    start.  Rows, not days: days without a row are skipped, as in the reference.
    Without ``by`` the frame runs over one ordered partition, which is meant for
    per-day aggregates (one row per day).  ``calendar`` takes the last ``rows``
    calendar days instead; ``order`` is then a date."""
    if calendar:
        day = F.datediff(F.col(order), F.lit("1970-01-01").cast("date"))
        w = Window.partitionBy(*by).orderBy(day).rangeBetween(-(rows - 1), 0)
    else:
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(-(rows - 1), 0)
    out = df
    for c in cols:
        out = out.withColumn(c + suffix, F.sum(F.coalesce(F.col(c), F.lit(0))).over(w))
    return out
