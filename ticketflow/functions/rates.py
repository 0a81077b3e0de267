"""Percentages and rounding.

The reference rounds with Python's ``round`` (ties to even) and, in one table,
with JavaScript's ``Math.round`` (ties up).  Every rate is computed in DOUBLE (a ``100.0`` SQL literal
would be DECIMAL and round differently).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timeops import ColLike, _c


def round_even(x: ColLike, digits: int) -> Column:
    """Python's ``round``: to the nearest decimal of the double itself, ties to even.

    ``bround`` rounds the double's shortest decimal, so where that ends in 5 one
    place further (k/20 with odd k, at one digit) it sees a tie that the double
    may not be.  There the exact remainder of 20 x - k decides (the product is
    split so that no bit is lost)."""
    q = _c(x).cast("double")
    if digits != 1:
        return F.bround(q, digits)
    k = F.rint(q * F.lit(20.0))
    big = F.lit(134217729.0) * q
    hi = big - (big - q)
    rest = (F.lit(20.0) * hi - k) + F.lit(20.0) * (q - hi)
    maybe = (k / F.lit(20.0) == q) & (k % F.lit(2.0) != 0)
    return (F.when(maybe & (rest > 0), (k + F.lit(1.0)) / F.lit(20.0))
            .when(maybe & (rest < 0), (k - F.lit(1.0)) / F.lit(20.0))
            .otherwise(F.bround(q, 1)))


def round_up(x: ColLike, digits: int) -> Column:
    return F.round(_c(x), digits)


def pct(num: ColLike, den: ColLike, digits: int = 1, on_zero: str = "null",
        half_up: bool = False) -> Column:
    """round(num * 100.0 / den, digits).

    on_zero: "null" -> NULL when den is 0 or NULL; "one" -> divide by 1 instead
    (the reference's ``den or 1``).
    """
    n = F.coalesce(_c(num), F.lit(0)).cast("double")
    d = _c(den).cast("double")
    if on_zero == "one":
        d = F.when(F.coalesce(d, F.lit(0.0)) == 0, F.lit(1.0)).otherwise(d)
        raw = n * F.lit(100.0) / d
    else:
        raw = F.when(F.coalesce(d, F.lit(0.0)) != 0, n * F.lit(100.0) / d)
    return round_up(raw, digits) if half_up else round_even(raw, digits)


def closed_rate(num: ColLike, a: ColLike, b: ColLike, digits: int = 1) -> Column:
    """Rate over closed = a + b, NULL when nothing closed."""
    closed = F.coalesce(_c(a), F.lit(0)) + F.coalesce(_c(b), F.lit(0))
    return pct(num, closed, digits)


def abs_change_pct(cur: ColLike, prev: ColLike) -> Column:
    """abs((cur - prev) / prev * 100), 0 when prev is 0."""
    c, p = _c(cur).cast("double"), _c(prev).cast("double")
    return F.when(p != 0, F.abs((c - p) / p * F.lit(100.0))).otherwise(F.lit(0.0))
