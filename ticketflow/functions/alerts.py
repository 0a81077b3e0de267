"""Trend, baseline comparison and signal rules as column expressions.

Each helper returns Columns, so the 16-row weekly table is computed inside the
plan like any other projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from .rates import abs_change_pct, round_even
from .timeops import ColLike, _c


def _last_two(values: Sequence[ColLike]) -> tuple[Column, Column, Column]:
    present = F.filter(F.array(*[_c(v).cast("double") for v in values]), lambda x: x.isNotNull())
    return F.size(present), F.try_element_at(present, F.lit(-1)), F.try_element_at(present, F.lit(-2))


def trend(values: Sequence[ColLike], flat_pct: float = C.TREND_FLAT_PCT) -> tuple[Column, Column]:
    """(text, dir) from the last two non-NULL values, oldest first.

    Fewer than two -> ('-', neutral); change under ``flat_pct`` percent of the
    previous value (or previous 0) -> ('Flat', neutral); else Up/up or Down/down.
    """
    n, last, prev = _last_two(values)
    diff = last - prev
    change = abs_change_pct(last, prev)
    text = (F.when(n < 2, "-").when(change < flat_pct, "Flat")
            .when(diff > 0, "Up").otherwise("Down"))
    direction = (F.when(n < 2, "neutral").when(change < flat_pct, "neutral")
                 .when(diff > 0, "up").otherwise("down"))
    return text, direction


def signed_pct(x: ColLike) -> Column:
    """A percentage with its sign and one decimal, '+3.4%'."""
    return F.format_string("%+.1f%%", _c(x))


def vs_baseline(cur: ColLike, base: ColLike, higher_is_good: bool | Column = True) -> tuple[Column, Column]:
    """(signed percent text, good|bad|neutral) of ``cur`` against ``base``.

    A baseline of 0 prints '+0%' (or '0%' for a fall); a difference of exactly
    0 counts as bad when lower is better, as in the reference.
    """
    c, b = _c(cur).cast("double"), _c(base).cast("double")
    hig = higher_is_good if isinstance(higher_is_good, Column) else F.lit(bool(higher_is_good))
    diff = c - b
    sign = F.when(diff >= 0, "+").otherwise("")
    pct = round_even(diff / b * F.lit(100.0), 1)
    text = F.when(c.isNull() | b.isNull(), "-") \
        .when(b == 0, F.concat(sign, F.lit("0%"))) \
        .otherwise(signed_pct(pct))
    good = ((diff >= 0) & hig) | ((diff < 0) & ~hig)
    direction = F.when(c.isNull() | b.isNull(), "neutral").when(good, "good").otherwise("bad")
    return text, direction


def signal_from_trend(trend_dir: ColLike, up_is: str) -> Column:
    """up -> ``up_is``; down -> the opposite; else neutral."""
    down_is = "good" if up_is == "bad" else "bad"
    d = _c(trend_dir)
    return F.when(d == "up", up_is).when(d == "down", down_is).otherwise("neutral")


def signal_from_baseline(vs_dir: ColLike) -> Column:
    d = _c(vs_dir)
    return F.when(d == "bad", "bad").when(d == "good", "good").otherwise("neutral")


def threshold_signal(label: ColLike, value: ColLike,
                     rules: Mapping[str, tuple[int | None, int | None, str]]) -> Column:
    """Per-label (bad above, warn above, otherwise) rule on a count."""
    lab, v = _c(label), _c(value)
    expr = None
    for name, (bad, warn, other) in rules.items():
        inner = F.lit(other)
        if warn is not None:
            inner = F.when(v > warn, "warn").otherwise(inner)
        if bad is not None:
            inner = F.when(v > bad, "bad").otherwise(inner)
        expr = F.when(lab == name, inner) if expr is None else expr.when(lab == name, inner)
    return expr.otherwise("neutral")


def pickup_verdict(pickup_pct: ColLike) -> tuple[Column, Column]:
    """('NN% picked' | '-', good above 30 / bad below 15 / neutral)."""
    p = _c(pickup_pct)
    text = F.when(p.isNull(), "-").otherwise(F.format_string("%.0f%% picked", p))
    direction = (F.when(p.isNotNull() & (p != 0) & (p > C.PICKUP_GOOD_ABOVE), "good")
                 .when(p.isNotNull() & (p < C.PICKUP_BAD_BELOW), "bad")
                 .otherwise("neutral"))
    return text, direction
