"""The key sketch: every needed row passes, most others are dropped before the first shuffle,
and a hot key is still combined map-side."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ticketflow.config import FIXTURE
from ticketflow.operators.dedupe import latest_per_key
from ticketflow.operators.joins import key_sketch, match_counts, only_keys_of
from ticketflow.plans import panels
from test_plans import plan_text
from test_skew import _shuffled_records, _skewed


def test_keeps_every_needed_row_and_drops_most_others(spark):
    rows = spark.range(200_000).select((F.col("id") * 7919 - 400_000_000).alias("k"), F.col("id").alias("v"))
    wanted = rows.filter(F.col("v") % 100 == 0).select(F.col("k").alias("w"))
    got = only_keys_of(rows, "k", wanted, "w")
    assert got.columns == ["k", "v"]
    assert got.filter(F.col("v") % 100 == 0).count() == 2000
    assert got.count() < 2000 + 200  # 2,000 keys in 2^26 bits: about 6 of 198,000 others
    tiny = only_keys_of(rows, "k", wanted, "w", words=4)  # a full bitmap only stops helping
    assert tiny.filter(F.col("v") % 100 == 0).count() == 2000


def test_sketch_is_bounded_whatever_the_keys(spark):
    keys = spark.range(100_000).withColumnRenamed("id", "k")
    assert key_sketch(keys, "k", 64).count() == 64
    assert key_sketch(keys.filter("k < 0"), "k").count() == 0


def test_no_keys_null_keys_and_text_keys(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4)], "k string, v int")
    none = spark.createDataFrame([], "w string")
    assert only_keys_of(rows, "k", none, "w").count() == 0
    some = spark.createDataFrame([("a",), (None,), ("a",)], "w string")
    assert {r.v for r in only_keys_of(rows, "k", some, "w").collect()} == {1, 3}


def test_keys_of_other_types_are_refused(spark):
    with pytest.raises(TypeError, match="different types"):
        only_keys_of(spark.range(3), "id", spark.range(3).select(F.col("id").cast("int").alias("w")), "w")


def test_hot_key_stays_one_row_a_map_task(spark):
    df = _skewed(spark)
    wanted = df.filter(F.col("k") < 5).select(F.col("k").alias("w"))
    top = latest_per_key(only_keys_of(df, "k", wanted, "w"), ["k"], [F.col("t").desc_nulls_first()])
    # the sketch's bits and the top-1 candidates: a few rows a map task each, of 300,000 rows with a third on one key
    assert all(n <= 8 * 8 for n in _shuffled_records(top))
    counts = match_counts(only_keys_of(df, "k", wanted, "w"), "k", {"even": F.col("even")})
    assert all(n <= 8 * 8 for n in _shuffled_records(counts))
    assert {r._mk for r in counts.collect()} == {0, 1, 2, 3, 4}


def _below_first_shuffle(text: str, mark: str) -> str:
    """The plan text from the line of ``mark`` to the next exchange under it."""
    after = text[text.index(mark):]
    end = after.find("Exchange hashpartitioning")
    return after if end < 0 else after[:end]


def test_latest_versions_are_filtered_below_the_partial_group_limit(tables):
    text = panels.closed_outcomes_daily(tables, FIXTURE, FIXTURE.baseline_start, FIXTURE.baseline_end) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in _below_first_shuffle(text, "Partial")


def test_rows_into_the_latest_version_follow_the_closures(spark, tables):
    """A closing range of two months dedupes the tickets closed in it, not the whole history."""
    p = panels.live_performance(tables).filter(F.col("task_resolved_time").between(F.lit("2001-05-01"), F.lit("2001-06-30")))
    cols = ("id", "created", "status")
    some = panels.latest_tickets_of(tables, cols, p, "reporterid")
    everything = panels.latest_tickets(tables, FIXTURE, cols)
    ids = {r[0] for r in p.select("reporterid").distinct().collect()}
    full = {r.id: r for r in everything.collect()}
    got = {r.id: r for r in some.collect()}
    assert ids & full.keys() <= got.keys() and all(got[i] == full[i] for i in got)
    assert len(got) < len(full) / 5
    assert max(_shuffled_records(some)) < max(_shuffled_records(everything)) / 5


def test_panels_equal_the_unfiltered_plans(tables):
    """The score cohort and the returns with and without the filter."""
    t, c = tables, FIXTURE
    lt = panels.latest_tickets(t, c)
    r = panels.returned_after_success(t, c)
    back = r.join(lt.select(F.col("id"), F.col("partner_id").alias("_p")), r["task_id"] == F.col("id"), "left")
    assert back.count() == r.count() > 0 and back.filter(~F.col("partner_id").eqNullSafe(F.col("_p"))).count() == 0
    assert "getbit" in plan_text(panels.cohort_score(t, c))
