"""Row filters.

Predicates on local (shifted) time are rewritten into ranges on the raw column
so Catalyst can push them into the scan (``PushedFilters`` on parquet) and
prune date partitions; the result is the same as filtering the shifted value.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeops import ColLike, _c, local_date, local_midnight_utc, ntz, raw_range_for_local_days


def eq(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))


def gt(df: DataFrame, col: str, n) -> DataFrame:
    return df.filter(F.col(col) > F.lit(n))


def not_deleted(df: DataFrame, flag: str = "_fivetran_deleted") -> DataFrame:
    """Soft-delete flag is false; a NULL flag is dropped as well (flag = false)."""
    return df.filter(F.col(flag) == F.lit(False))


def is_null(c: ColLike) -> Column:
    return _c(c).isNull()


def not_null(c: ColLike) -> Column:
    return _c(c).isNotNull()


def in_set(c: ColLike, values: Iterable) -> Column:
    return _c(c).isin(list(values))


def any_of(*conds: Column) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def local_date_between(ts: ColLike, lo: date | None, hi: date | None, minutes: int) -> Column:
    """to_date(ts + minutes) BETWEEN lo AND hi, as a half-open raw range.

    Either bound may be None (open side).  NULL ``ts`` fails the test, as it
    does in the shifted form.
    """
    start, end = raw_range_for_local_days(lo, hi, minutes)
    c = _c(ts)
    cond = c.isNotNull()
    if start is not None:
        cond = cond & (c >= ntz(start))
    if end is not None:
        cond = cond & (c < ntz(end))
    return cond


def lookback(ts: ColLike, as_of: date, days: int, minutes: int = 0) -> Column:
    """ts (+ minutes) >= as_of - days at midnight.  With ``minutes`` the test is
    on shifted time, expressed on the raw column."""
    return _c(ts) >= ntz(local_midnight_utc(as_of - timedelta(days=days), minutes))


def expired_before(expiry: ColLike, as_of: date, grace_days: int, minutes: int = 0) -> Column:
    """(expiry + minutes) + grace_days < as_of at midnight."""
    bound = local_midnight_utc(as_of - timedelta(days=grace_days), minutes)
    return _c(expiry) < ntz(bound)


def date_window(d: ColLike, as_of: date, days: int) -> Column:
    """as_of - days <= d <= as_of."""
    return _c(d).between(F.lit(as_of - timedelta(days=days)), F.lit(as_of))


def matured(created: ColLike, as_of: date, start: date, days: int, minutes: int) -> Column:
    """Created on a local day in [start, as_of - days] (cohort maturity rule)."""
    return local_date_between(created, start, as_of - timedelta(days=days), minutes)


def in_range(d: ColLike, start: date, end: date) -> Column:
    return _c(d).between(F.lit(start), F.lit(end))


# ---- DataFrame-level ranges on a fact table's time column, partition-aware

def partition_column(ts: str) -> str:
    """Name of the date partition column derived from time column ``ts``
    (see ``sources.tables.write_partitioned``)."""
    return f"{ts}__date"


def in_window(df: DataFrame, ts: str, start: datetime | None, end: datetime | None,
              keep_null: bool = False) -> DataFrame:
    """Rows with start <= ts < end on the raw column (and rows with a NULL ts
    when ``keep_null``).  When ``df`` is stored partitioned by the UTC date of
    ``ts``, the same bounds are put on that partition column, so whole date
    partitions are skipped, not just row groups."""
    c = F.col(ts)
    cond = c.isNotNull()
    if start is not None:
        cond = cond & (c >= ntz(start))
    if end is not None:
        cond = cond & (c < ntz(end))
    if keep_null:
        cond = cond | c.isNull()
    part = partition_column(ts)
    if part in df.columns:
        d = F.col(part)
        pcond = d.isNotNull()
        if start is not None:
            pcond = pcond & (d >= F.lit(start.date()))
        if end is not None:
            pcond = pcond & (d <= F.lit((end - timedelta(microseconds=1)).date()))
        if keep_null:
            pcond = pcond | d.isNull()
        cond = cond & pcond
    return df.filter(cond)


def on_local_days(df: DataFrame, ts: str, lo: date | None, hi: date | None, minutes: int,
                  keep_null: bool = False) -> DataFrame:
    """Rows whose local day (ts + minutes) is in [lo, hi]; see ``in_window``."""
    start, end = raw_range_for_local_days(lo, hi, minutes)
    return in_window(df, ts, start, end, keep_null)


def on_days(df: DataFrame, ts: str, days: Sequence[date], minutes: int) -> DataFrame:
    """Rows whose local day (ts + minutes) is one of ``days``.  The range they span reaches the scan;
    of a table stored by the UTC date of ``ts`` only the partitions that hold such a day are read."""
    if not days:
        return df.filter(F.lit(False))
    df = on_local_days(df, ts, min(days), max(days), minutes)
    part = partition_column(ts)
    if part in df.columns:
        ends = [raw_range_for_local_days(d, d, minutes) for d in days]
        utc = {at.date() for a, b in ends for at in (a, b - timedelta(microseconds=1))}
        df = df.filter(F.col(part).isin(sorted(utc)))
    return df.filter(local_date(ts, minutes).isin(list(days)))


def since(df: DataFrame, ts: str, as_of: date, days: int, minutes: int = 0) -> DataFrame:
    """Rows with ts (+ minutes) >= as_of - days at midnight; see ``in_window``."""
    return in_window(df, ts, local_midnight_utc(as_of - timedelta(days=days), minutes), None)
