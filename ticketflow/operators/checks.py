"""Data-quality checks that run as aggregates (one small row back, no row scan
on the driver)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jsonops import is_bad


def constant_offset(df: DataFrame, a: str, b: str, minutes: int) -> DataFrame:
    """How many rows have ``b - a`` equal to exactly ``minutes`` minutes.

    A column pair where every row differs by the local-time shift points to one
    instant shifted twice.  Returns rows, matching, share (0..1)."""
    diff = F.timestamp_diff("MINUTE", F.col(a), F.col(b))
    exact = (diff == minutes) & (F.col(a) + F.make_dt_interval(mins=F.lit(minutes)) == F.col(b))
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_if(exact).alias("matching")) \
        .withColumn("share", F.col("matching") / F.greatest(F.col("rows"), F.lit(1)))


def bad_json(df: DataFrame, col: str) -> DataFrame:
    """Count of present values that are not JSON documents."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(is_bad(col)).alias("bad_json"))
