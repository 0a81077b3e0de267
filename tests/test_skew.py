"""A key holding a third of all rows: the operators reduce it map-side, so the
shuffle carries at most one row per (key, map task), whatever the skew."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ticketflow.operators.dedupe import existing_keys, latest_per_key
from ticketflow.operators.joins import first_after, match_counts, next_times
from ticketflow.operators.windows import last_events, next_event

N, PARTS, KEYS = 300_000, 8, 1000


def _skewed(spark):
    # key 0 holds a third of the rows
    return spark.range(N, numPartitions=PARTS).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % KEYS + 1).alias("k"),
        F.col("id").alias("t"), (F.col("id") % 2 == 0).alias("even"))


def _shuffled_records(df) -> list[int]:
    """Records written by each shuffle of the executed (post-AQE) plan."""
    def nodes(p):
        yield p
        ch = p.children()
        for i in range(ch.size()):
            yield from nodes(ch.apply(i))
        name = p.getClass().getSimpleName()
        if name.endswith("QueryStageExec"):
            yield from nodes(p.plan())
        if name == "AdaptiveSparkPlanExec":
            yield from nodes(p.executedPlan())
    df.collect()
    root = df._jdf.queryExecution().executedPlan()
    return [n.metrics().apply("shuffleRecordsWritten").value()
            for n in nodes(root) if n.getClass().getSimpleName() == "ShuffleExchangeExec"]


def test_latest_per_key_ships_one_row_per_key_and_task(spark):
    out = latest_per_key(_skewed(spark), ["k"], [F.desc("t")])
    recs = _shuffled_records(out)
    assert recs and max(recs) <= (KEYS + 1) * PARTS
    assert out.filter(F.col("k") == 0).first().t == (N - 1) // 3 * 3  # largest id divisible by 3


def test_last_events_hot_key(spark):
    out = last_events(_skewed(spark), "k", "t")
    assert max(_shuffled_records(out)) <= (KEYS + 1) * PARTS
    assert out.count() == KEYS + 1


def test_match_counts_and_existence_combine_map_side(spark):
    c = match_counts(_skewed(spark), "k", {"even": F.col("even")})
    assert max(_shuffled_records(c)) <= (KEYS + 1) * PARTS
    hot = c.filter(F.col("_mk") == 0).first()
    assert hot._n == N // 3 and hot.even == N // 6
    e = existing_keys(_skewed(spark), "k")
    assert max(_shuffled_records(e)) <= (KEYS + 1) * PARTS


def test_first_after_hot_key_spread_over_days(spark):
    rnd = random.Random(5)
    base = datetime(2025, 1, 1)
    left = [(i, "HOT" if i % 3 == 0 else f"D{i % 50}", base + timedelta(minutes=rnd.randrange(0, 60 * 1440)))
            for i in range(3000)]
    right = [("HOT" if j % 3 == 0 else f"D{j % 50}", base + timedelta(minutes=rnd.randrange(0, 70 * 1440)))
             for j in range(900)]
    ldf = spark.createDataFrame(left, "i long, k string, t timestamp_ntz")
    rdf = spark.createDataFrame(right, "k string, t timestamp_ntz")
    got = {r.i: r.nx for r in first_after(ldf, rdf, "k", "k", "t", "t", "nx").collect()}
    by_key: dict[str, list[datetime]] = {}
    for k, t in right:
        by_key.setdefault(k, []).append(t)
    for i, k, t in left:
        later = [x for x in by_key.get(k, []) if x > t]
        assert got[i] == (min(later) if later else None)


def test_first_after_null_keys_spread_and_unmatched(spark):
    base = datetime(2025, 1, 1)
    left = spark.range(30_000, numPartitions=PARTS).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("D"), (F.col("id") % 7).cast("string")))
        .alias("k"), F.col("id").alias("i"),
        (F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") % 5000).cast("int"))).alias("t"))
    right = spark.createDataFrame([("D1", base + timedelta(days=10))], "k string, t timestamp_ntz")
    out = first_after(left, right, "k", "k", "t", "t", "nx")
    assert out.count() == 30_000
    assert out.filter(F.col("k").isNull() & F.col("nx").isNotNull()).count() == 0
    assert out.filter(F.col("k") == "D1").filter(F.col("nx").isNull()).count() == 0


def test_next_times_of_one_minute_and_one_instant(spark):
    """A device whose rows all fall into one minute: no window holds more than its distinct instants of a
    second, and rows of one instant are one row."""
    base = datetime(2025, 1, 1)
    n = 60_000
    left = spark.range(n, numPartitions=PARTS).select(
        F.lit("HOT").alias("k"), F.col("id").alias("i"),
        (F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("id") % 6000 / 100).cast("decimal(18,6)"))).alias("t"))
    right = left.filter(F.col("i") % 7 == 0).select("k", "t")
    times = left.select(F.col("k").alias("_k"), F.col("t").alias("_t")).groupBy("_k", "_t").agg(F.max("_t").alias("_r"))
    recs = _shuffled_records(next_times(times))
    assert max(recs) <= 6000 * PARTS                       # instants of each task, not rows
    got = first_after(left, right, "k", "k", "t", "t", "nx")
    # instants are 10 ms apart, and every one is a right time for some row (6000 and 7 have no common divisor)
    step = F.lit(timedelta(milliseconds=10))
    wrong = got.filter(~F.when(F.col("i") % 6000 == 5999, F.col("nx").isNull()).otherwise(F.col("nx") == F.col("t") + step))
    assert got.count() == n and wrong.count() == 0
    one = left.withColumn("t", F.lit(base).cast("timestamp_ntz"))
    assert max(_shuffled_records(next_times(one.select(F.col("k").alias("_k"), F.col("t").alias("_t")).groupBy("_k", "_t")
                                            .agg(F.max("_t").alias("_r"))))) <= PARTS
    lead = next_event(one, "k", "t", ["i"], "nx")
    assert lead.filter(F.col("nx").isNull()).collect()[0].i == n - 1 and lead.filter(F.col("nx").isNotNull()).count() == n - 1


def test_first_after_ships_left_rows_once(spark):
    """Rows at instants of their own: one shuffle carries them, the others a key's days and seconds with events."""
    base, n = datetime(2025, 1, 1), 30_000
    left = spark.range(n, numPartitions=PARTS).select(
        F.concat(F.lit("D"), (F.col("id") % 7).cast("string")).alias("k"), F.col("id").alias("i"),
        (F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("id") * 7).cast("decimal(18,6)"))).alias("t"))
    times = [("D1", base + timedelta(hours=h, microseconds=u)) for h in (3, 30, 99) for u in (0, 5, 9)] + [("D1", base + timedelta(seconds=7))]
    right = spark.createDataFrame(times, "k string, t timestamp_ntz")
    out = first_after(left, right, "k", "k", "t", "t", "nx")
    assert sum(_shuffled_records(out)) < 1.5 * n
    for r in out.filter(F.col("k") == "D1").collect():
        later = [t for _, t in times if t > r.t]
        assert r.nx == (min(later) if later else None)
    assert out.count() == n and out.filter((F.col("k") != "D1") & F.col("nx").isNotNull()).count() == 0


def test_max_gap(spark):
    base = datetime(2025, 1, 1)
    left = spark.createDataFrame([(1, "a", base), (2, "a", base + timedelta(days=5)), (3, None, base), (4, "a", None), (5, "b", base)],
                                 "i long, k string, t timestamp_ntz")
    right = spark.createDataFrame([("a", base + timedelta(days=3)), ("a", base + timedelta(days=9)), (None, base)], "k string, t timestamp_ntz")

    def got(gap):
        return {r.i: r.nx for r in first_after(left, right, "k", "k", "t", "t", "nx", gap).collect()}
    day3, day9 = base + timedelta(days=3), base + timedelta(days=9)
    assert got(None) == {1: day3, 2: day9, 3: None, 4: None, 5: None}
    assert got(timedelta(days=3)) == {1: day3, 2: None, 3: None, 4: None, 5: None}
    assert got(timedelta(days=3) - timedelta(microseconds=1)) == {1: None, 2: None, 3: None, 4: None, 5: None}


def test_status_lookup_sees_hot_ticket_collapsed(spark):
    """One ticket holds a third of the performance rows: it reaches the join
    with the latest ticket version as one row per (day, type), not 20,000."""
    from datetime import date

    from ticketflow.config import Config
    from ticketflow.plans import panels
    from ticketflow.sources.fixtures import Tables
    from ticketflow.sources.tables import SCHEMAS
    n = 60_000
    tasks = spark.range(0, 20_000, numPartitions=PARTS).select(
        F.col("id"), F.lit(None).cast("long").alias("reporter_id"),
        F.lit(datetime(2025, 11, 10)).cast("timestamp_ntz").alias("created"),
        F.lit(None).cast("timestamp_ntz").alias("rslvd_datetime"), (F.col("id") % 4).cast("int").alias("status"),
        F.lit(1).cast("long").alias("partner_id"), F.lit("ROUTER_PICKUP").alias("type"),
        F.lit(None).cast("string").alias("extra_data"))
    perf = spark.range(0, n, numPartitions=PARTS).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 20_000).alias("reporterid"),
        F.lit("ROUTER_PICKUP").alias("task_type"),
        (F.lit(datetime(2025, 12, 1)).cast("timestamp_ntz")
         + F.make_dt_interval(mins=(F.col("id") % 10_000).cast("int"))).alias("task_resolved_time"),
        F.lit(None).cast("string").alias("task_resolution_type"), F.lit(1).alias("score"),
        F.lit(None).cast("string").alias("customer_device_id"), F.lit(False).alias("_fivetran_deleted"))
    empty = {k: spark.createDataFrame([], SCHEMAS[k]) for k in ("task_logs", "router_user_mapping", "device_audit")}
    t = Tables(tasks, perf, empty["task_logs"], empty["router_user_mapping"], empty["device_audit"], None)
    old = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")   # force the shuffled join
    try:
        df = panels.closed_daily(t, Config(as_of=date(2025, 12, 20), cohort_start=date(2025, 11, 1)))
        assert df.agg(F.sum("total_closed")).first()[0] == n
        recs = _shuffled_records(df)
        # other rows are nearly unique per (ticket, day); the hot ticket adds at most days x map tasks
        assert max(recs) <= (n - n // 3) + PARTS * 8
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)
