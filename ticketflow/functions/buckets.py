"""Labelled integer ranges (CASE .. BETWEEN .. ELSE) and their display order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from .timeops import ColLike, _c

Buckets = Sequence[tuple[str, int | None, int | None]]


def age_bucket(days: ColLike, buckets: Buckets) -> Column:
    """First bucket whose [low, high] holds the value; the last label takes the
    rest (negative ages and NULL included, as in the reference's ELSE)."""
    d = _c(days)
    expr = None
    for label, lo, hi in buckets[:-1]:
        cond = d.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    last = buckets[-1][0]
    return F.lit(last) if expr is None else expr.otherwise(last)


def bucket_rank(label: ColLike, buckets: Buckets) -> Column:
    """CASE label WHEN b1 THEN 1 .. ELSE n (ORDER BY of the reference)."""
    lab = _c(label)
    expr = None
    for i, (name, _, _) in enumerate(buckets[:-1], start=1):
        expr = F.when(lab == name, i) if expr is None else expr.when(lab == name, i)
    n = len(buckets)
    return F.lit(n) if expr is None else expr.otherwise(n)


def bucket_frame(spark: SparkSession, buckets: Buckets, name: str = "age_bucket") -> DataFrame:
    """The bucket dimension: one row per label with its rank (a handful of rows,
    fixed by configuration, so safe to broadcast)."""
    schema = StructType([StructField(name, StringType(), False),
                         StructField("bucket_rank", IntegerType(), False)])
    return spark.createDataFrame([(b[0], i) for i, b in enumerate(buckets, start=1)], schema)
