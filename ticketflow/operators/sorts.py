"""Result ordering, applied once at the end of a panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_period(df: DataFrame, col: str) -> DataFrame:
    return df.orderBy(F.col(col).asc_nulls_last())


def numbered(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """The place of each row in the result's order, as a column (1 first), for results
    that are stored without one.  Meant for panels: a row per day, month or bucket."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def by_bucket(df: DataFrame, rank: Column) -> DataFrame:
    return df.orderBy(rank)


def newest_first(df: DataFrame, ts: str, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(ts).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties])
