"""Time helpers (column expressions only).

Source times are TIMESTAMP_NTZ holding UTC wall time; local (IST) time is the
raw value shifted by a fixed number of minutes, exactly once.  Local days are
DATE values; text labels are made only where a result leaves the plan.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

ColLike = Column | str


def _c(c: ColLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(value: datetime | date) -> Column:
    """A TIMESTAMP_NTZ literal (a Python datetime would become an LTZ literal)."""
    if not isinstance(value, datetime):
        value = datetime.combine(value, time())
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(TimestampNTZType())


def minutes(n: int | Column) -> Column:
    """A day-time interval of ``n`` minutes.  Adding it to a TIMESTAMP_NTZ is a
    plain microsecond addition (a literal ``n`` folds to an interval literal),
    cheaper per row than ``timestamp_add`` and identical on wall-clock times."""
    return F.make_dt_interval(mins=n if isinstance(n, Column) else F.lit(n))


def days(n: int | Column) -> Column:
    return F.make_dt_interval(days=n if isinstance(n, Column) else F.lit(n))


def to_local(ts: ColLike, minutes_: int) -> Column:
    """UTC wall time -> local wall time (DATEADD(minute, n, ts))."""
    return _c(ts) + minutes(minutes_)


def add_days(c: ColLike, n: int, is_date: bool = True) -> Column:
    """DATEADD(day, n, x) keeping the input type (date stays date)."""
    return F.date_add(_c(c), n) if is_date else _c(c) + days(n)


def local_date(ts: ColLike, minutes: int) -> Column:
    """TO_DATE(DATEADD(minute, n, ts))."""
    return F.to_date(to_local(ts, minutes))


def period_start(d: ColLike, unit: str) -> Column:
    """First day of the month / ISO week (Monday) holding date ``d``."""
    return _c(d) if unit == "day" else F.trunc(_c(d), unit)


# Text labels are cut from the value's own string form (DATE -> yyyy-MM-dd,
# TIMESTAMP_NTZ -> yyyy-MM-dd HH:mm:ss[.ffffff]), which involves no time zone:
# date_format would pass through the session zone and move wall times that
# fall into a daylight-saving gap there.
_LABEL_LEN = {"day": 10, "week": 10, "month": 7}

# English month abbreviations for the 'dd MMM' week caption.
MONTH_ABBR = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def period_label(d: ColLike, unit: str = "day") -> Column:
    """TO_CHAR(.., 'YYYY-MM-DD' | 'YYYY-MM') of a DATE."""
    return F.substring(_c(d).cast("string"), 1, _LABEL_LEN[unit])


def day_label(d: ColLike) -> Column:
    """'09 Jul' style week caption."""
    months = F.array(*[F.lit(m) for m in MONTH_ABBR])
    return F.concat(F.lpad(F.dayofmonth(_c(d)).cast("string"), 2, "0"), F.lit(" "),
                    F.element_at(months, F.month(_c(d))))


def ntz_text(ts: ColLike, unit: str = "minute") -> Column:
    """A TIMESTAMP_NTZ as 'yyyy-MM-dd HH:mm' | '.. HH:mm:ss' | '.. HH:mm:ss.ffffff'."""
    s = _c(ts).cast("string")
    if unit == "minute":
        return F.substring(s, 1, 16)
    if unit == "second":
        return F.substring(s, 1, 19)
    frac = F.rpad(F.regexp_extract(s, r"\.(\d+)$", 1), 6, "0")
    return F.when(s.isNotNull(), F.concat(F.substring(s, 1, 19), F.lit("."), frac))


def age_days(d: ColLike, as_of: date) -> Column:
    """DATEDIFF(day, d, as_of) on dates (date boundaries, never elapsed time)."""
    return F.datediff(F.lit(as_of), _c(d))


def iso_date(s: ColLike) -> Column:
    """ISO text -> date, reading the first 10 characters."""
    return F.to_date(F.substring(_c(s), 1, 10))


def minute_text(ts: ColLike) -> Column:
    return ntz_text(ts, "minute")


# ---- bounds on the raw column (sargable forms of the local-time predicates)

def local_midnight_utc(d: date, minutes: int) -> datetime:
    """Raw (UTC wall) instant at which local day ``d`` starts."""
    return datetime.combine(d, time()) - timedelta(minutes=minutes)


def raw_range_for_local_days(lo: date | None, hi: date | None, minutes: int) -> tuple[datetime | None, datetime | None]:
    """Half-open raw range [start, end) equal to local_date(ts) BETWEEN lo AND hi."""
    start = local_midnight_utc(lo, minutes) if lo is not None else None
    end = local_midnight_utc(hi + timedelta(days=1), minutes) if hi is not None else None
    return start, end
