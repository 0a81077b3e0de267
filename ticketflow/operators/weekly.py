"""Weekly roll-ups of per-day panels: weekly means, ratios of sums, totals,
baselines over a fixed date range, and the last complete ISO weeks.

Inputs are per-day aggregates (one row per day), so these stay small no matter
how large the fact tables are; the week list is a three-row frame derived from
the as-of date and joined by week start.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from ..functions.rates import pct, round_even
from ..functions.timeops import day_label
from .filters import in_range


def last_full_weeks(as_of: date, n: int = 3) -> list[tuple[str, date, date]]:
    """The ``n`` most recent complete Monday-Sunday weeks before ``as_of``'s
    week, oldest first, labelled W-n .. W-1."""
    monday = as_of - timedelta(days=as_of.weekday())
    out = []
    for k in range(n, 0, -1):
        start = monday - timedelta(weeks=k)
        out.append((f"W-{k}", start, start + timedelta(days=6)))
    return out


def week_frame(spark: SparkSession, as_of: date, n: int = 3) -> DataFrame:
    """Weeks as rows: slot (n..1, W-slot), week_start, week_end, caption."""
    schema = StructType([StructField("slot", IntegerType(), False),
                         StructField("week_start", DateType(), False),
                         StructField("week_end", DateType(), False)])
    rows = [(int(lbl[2:]), s, e) for lbl, s, e in last_full_weeks(as_of, n)]
    return spark.createDataFrame(rows, schema).withColumn("caption", day_label("week_start"))


def by_week(daily: DataFrame, d: str) -> DataFrame:
    return daily.withColumn("week_start", F.trunc(F.col(d), "week"))


def avg_per_day(daily: DataFrame, d: str, value: str, name: str = "avg_per_day") -> DataFrame:
    """Per ISO week: mean of ``value`` over the days present, rounded to 0
    decimals half-even (days without a row do not count)."""
    return (by_week(daily, d).groupBy("week_start")
            .agg(round_even(F.avg(F.coalesce(F.col(value), F.lit(0))), 0).alias(name)))


def ratio(daily: DataFrame, d: str, num: str, den: str, name: str = "pct",
          digits: int = 1) -> DataFrame:
    """Per ISO week: sum(num) * 100 / sum(den), NULL when the denominator is 0."""
    return (by_week(daily, d).groupBy("week_start")
            .agg(F.sum(F.coalesce(F.col(num), F.lit(0))).alias("_num"),
                 F.sum(F.coalesce(F.col(den), F.lit(0))).alias("_den"))
            .withColumn(name, pct("_num", "_den", digits))
            .drop("_num", "_den"))


def total(df: DataFrame, by: Sequence[str], value: str, name: str = "total") -> DataFrame:
    """Per group: sum of ``value``; NULL when the group has no value (a week
    without rows stays empty rather than 0)."""
    return df.groupBy(*by).agg(F.sum(F.col(value)).cast("bigint").alias(name))


def baseline_avg(daily: DataFrame, d: str, value: str, start: date, end: date,
                 name: str = "baseline") -> DataFrame:
    """Mean over the days present in [start, end], 0 decimals; NULL if none."""
    return (daily.filter(in_range(d, start, end))
            .agg(round_even(F.avg(F.coalesce(F.col(value), F.lit(0))), 0).alias(name)))


def slots(d: str, as_of: date, n: int = 3, baseline: tuple[date, date] | None = None) -> Column:
    """The slots a day belongs to: k for week W-k (k = n..1) and 0 for the
    baseline range.  Week bounds are literals from the as-of date, so tagging
    needs no join; a day can sit in a week and in the baseline at once."""
    parts = [F.when(F.col(d).between(F.lit(s), F.lit(e)), F.lit(int(lbl[2:])))
             for lbl, s, e in last_full_weeks(as_of, n)]
    if baseline is not None:
        parts.append(F.when(F.col(d).between(F.lit(baseline[0]), F.lit(baseline[1])), F.lit(0)))
    return F.array_compact(F.array(*parts))


def slot_sums(daily: DataFrame, d: str, cols: Sequence[str], as_of: date, n: int = 3,
              baseline: tuple[date, date] | None = None) -> DataFrame:
    """Per slot with at least one day: days present (``_days``) and the sums
    of ``cols``.  One pass over the per-day panel for all weeks and the
    baseline together."""
    tagged = daily.select(F.explode(slots(d, as_of, n, baseline)).alias("slot"), *cols)
    return tagged.groupBy("slot").agg(F.count(F.lit(1)).alias("_days"),
                                      *[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in cols])


def by_slot(per_slot: DataFrame, value: Column, n: int = 3, with_baseline: bool = True) -> list[Column]:
    """Aggregates turning (slot, value) rows into w{n}..w1 [, baseline]."""
    names = [(k, f"w{k}") for k in range(n, 0, -1)] + ([(0, "baseline")] if with_baseline else [])
    return [F.max(F.when(F.col("slot") == k, value)).alias(name) for k, name in names]
