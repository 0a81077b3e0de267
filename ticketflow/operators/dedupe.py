"""Latest row per key and key existence.

``latest_per_key`` is ROW_NUMBER() = 1 over a hash partitioning of the key.
Spark plans it as a partial WindowGroupLimit before the exchange and a final
one after it, so each map task forwards at most one row per key: a hot key
cannot pile its rows into one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   rn_col: str = "_rn") -> DataFrame:
    """Keep the first row per ``keys`` under ``order``.

    ``order`` must spell out NULL placement and ties, e.g.
    ``[F.desc_nulls_first("created"), F.desc_nulls_first("status")]``: the
    reference's dialect sorts NULL as the largest value, so a NULL time is
    "latest" there.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rn_col, F.row_number().over(w)).filter(F.col(rn_col) == 1).drop(rn_col)


def existing_keys(df: DataFrame, key: Column | str, name: str | None = None) -> DataFrame:
    """Distinct non-NULL values of ``key``: what a latest-per-key CTE reduces to
    when only the key's existence is used afterwards (hash aggregate with
    map-side combine, no sort)."""
    k = F.col(key) if isinstance(key, str) else key
    name = name or (key if isinstance(key, str) else "key")
    return df.select(k.alias(name)).filter(F.col(name).isNotNull()).distinct()
