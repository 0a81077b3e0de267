"""Grouped counts.

Conditional counts use ``count_if`` (0, never NULL, for an empty class, like
SUM(CASE .. THEN 1 ELSE 0)).  All aggregates here are hash aggregates with a
partial (map-side) step, so skewed groups are combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.buckets import Buckets


def count_by(df: DataFrame, by: Sequence[Column | str], name: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def outcome_counts(df: DataFrame, by: Sequence[Column | str], total: str | None,
                   outcomes: Mapping[str, Column]) -> DataFrame:
    """One row per group: optional row count ``total`` and one count per outcome."""
    aggs = ([F.count(F.lit(1)).alias(total)] if total else []) + \
        [F.count_if(cond).alias(name) for name, cond in outcomes.items()]
    return df.groupBy(*by).agg(*aggs)


def weighted_counts(df: DataFrame, by: Sequence[Column | str], measures: Mapping[str, Column]) -> DataFrame:
    """Sums of per-row weights (row multiplicities of a pre-counted join)."""
    return df.groupBy(*by).agg(*[F.sum(w).cast("bigint").alias(n) for n, w in measures.items()])


def zero_fill(df: DataFrame, buckets: Buckets, measures: Sequence[str],
              label: str = "age_bucket") -> DataFrame:
    """Every bucket present, in rank order, missing measures 0: one aggregate with a
    struct for each bucket of the configuration, unfolded; no join."""
    rows = [F.struct(F.lit(b[0]).alias(label), F.lit(i).alias("bucket_rank"), *[
        F.coalesce(F.max(F.when(F.col(label) == b[0], F.col(m))), F.lit(0)).cast("bigint").alias(m) for m in measures])
        for i, b in enumerate(buckets, start=1)]
    return df.agg(F.array(*rows).alias("_rows")).select(F.explode("_rows").alias("_r")).select("_r.*")


def bucket_total(df: DataFrame, label: str, labels: Sequence[str], measure: str,
                 name: str = "total") -> DataFrame:
    """Sum of ``measure`` over the chosen bucket labels (0 when none)."""
    return (df.filter(F.col(label).isin(list(labels)))
            .agg(F.coalesce(F.sum(measure), F.lit(0)).cast("bigint").alias(name)))


def with_total(df: DataFrame, dim: str, measures: Sequence[str], label: str = "Total") -> DataFrame:
    """Rows per ``dim`` plus a grand-total row labelled ``label``, which is there (0)
    for an empty input too."""
    per = df.groupBy(dim).agg(*[F.sum(m).cast("bigint").alias(m) for m in measures])
    total = per.agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in measures])
    return per.unionByName(total.select(F.lit(label).alias(dim), *measures))


def exact_median(df: DataFrame, value: str, width: int = 3600, name: str = "median",
                 count: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Exact median of an integer column (the mean of the two middle values for
    an even count, as percentile_cont(0.5)); one row, NULL for no values, or one row for
    each group of ``by`` that has values.
    ``count`` names a column of row counts where ``df`` is a histogram already.

    Two histogram passes keep every piece of state bounded: counts per coarse
    bucket of ``width`` units locate the buckets holding the middle ranks
    (cumulative sums over the histogram, whose size is the value range divided
    by ``width``), then counts per distinct value inside those at most two
    buckets (at most ``width`` values each) pick the values.  No task ever
    holds the values themselves; with ``by`` the group is part of both histograms'
    keys, so a group with a third of all rows is a few counts a map task.
    """
    # NULL values weigh nothing; a filter would be pushed below the caller's
    # histogram and keep its shuffle from being shared.
    weight = F.when(F.col(value).isNull(), 0).otherwise(F.lit(1) if count is None else F.col(count)).cast("long")
    v = df.select(*by, F.col(value).cast("long").alias("_v"), weight.alias("_w")) \
        .withColumn("_b", F.floor(F.col("_v") / F.lit(width)))
    hist = v.groupBy(*by, "_b").agg(F.sum("_w").alias("_c"))
    cum = F.sum("_c").over(Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("_c").over(Window.partitionBy(*by))
    hist = hist.select(*by, "_b", "_c", cum.alias("_cum"), total.alias("_n"))
    lo = F.floor((F.col("_n") - 1) / 2) + 1  # 1-based ranks of the middle values
    hi = F.floor(F.col("_n") / 2) + 1
    before = F.col("_cum") - F.col("_c")

    def holds(rank: Column) -> Column:
        return (before < rank) & (F.col("_cum") >= rank)

    hit = hist.filter(holds(lo) | holds(hi)).select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col("_b").alias("_hb"),
                                                    before.alias("_before"), lo.alias("_lo"), hi.alias("_hi"))
    # Without groups ``hit`` has at most two rows, so broadcasting it is bounded by construction; with
    # them it has two a group, and the values are counted before they meet it.
    if by:
        v = v.groupBy(*by, "_b", "_v").agg(F.sum("_w").alias("_w"))
    same = F.col("_b") == F.col("_hb")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    fine = v.join(hit if by else F.broadcast(hit), same).groupBy(*by, "_b", "_v", "_before", "_lo", "_hi") \
        .agg(F.sum("_w").alias("_c"))
    end = F.col("_before") + F.sum("_c").over(
        Window.partitionBy(*by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    fine = fine.withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("_c") + 1)

    def value_at(rank: str) -> Column:
        return F.max(F.when((F.col("_start") <= F.col(rank)) & (F.col(rank) <= F.col("_end")), F.col("_v")))

    return fine.groupBy(*by).agg(((value_at("_lo") + value_at("_hi")) / F.lit(2.0)).alias(name))
