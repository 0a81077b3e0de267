"""Hand-made edge frames for the operators (the driver's tables hold no NULLs
and only midnight times, so these cases cannot come from them)."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from ticketflow import config as C
from ticketflow.functions import alerts, jsonops
from ticketflow.functions.buckets import age_bucket, bucket_rank
from ticketflow.functions.rates import pct
from ticketflow.functions.timeops import local_date
from ticketflow.operators import filters as P
from ticketflow.operators.agg import with_total, zero_fill
from ticketflow.operators.dedupe import existing_keys, latest_per_key
from ticketflow.operators.joins import exists_flag, first_after, match_counts
from ticketflow.operators.weekly import last_full_weeks
from ticketflow.operators.windows import last_events, next_event, rolling_sums

TS = "id long, created timestamp_ntz, status int"


def ts(s):
    return datetime.fromisoformat(s)


def test_latest_per_key_null_created_is_latest_and_ties_are_ordered(spark):
    rows = [(1, ts("2025-11-01 10:00"), 3), (1, None, 0),            # NULL time sorts as largest
            (2, ts("2025-11-01 10:00"), 1), (2, ts("2025-11-01 10:00"), 2),  # tie -> higher status
            (3, ts("2025-11-02 00:00"), 2), (3, ts("2025-11-01 00:00"), 3)]  # latest success wins
    df = spark.createDataFrame(rows, TS)
    out = latest_per_key(df, ["id"], [F.desc_nulls_first("created"), F.desc_nulls_first("status")])
    got = {r.id: r.status for r in out.collect()}
    assert got == {1: 0, 2: 2, 3: 2}


def test_status_filter_after_dedupe_keeps_stale_failure_out(spark):
    rows = [(7, ts("2025-11-02 00:00"), 2), (7, ts("2025-11-01 00:00"), 3)]
    df = spark.createDataFrame(rows, TS)
    latest = latest_per_key(df, ["id"], [F.desc_nulls_first("created")])
    assert latest.filter(F.col("status") == 3).count() == 0      # after the window
    assert df.filter(F.col("status") == 3).count() == 1          # before it (alert Q6 form)


def test_local_day_edge_at_1830_utc(spark):
    df = spark.createDataFrame([(ts("2025-11-30 18:29:59"),), (ts("2025-11-30 18:30:00"),), (None,)],
                               "t timestamp_ntz")
    days = [r.d for r in df.select(local_date("t", 330).alias("d")).collect()]
    assert days == [date(2025, 11, 30), date(2025, 12, 1), None]
    # The sargable raw range equals the shifted-date test, NULL excluded.
    cond = P.local_date_between("t", date(2025, 12, 1), date(2025, 12, 1), 330)
    assert [r.t for r in df.filter(cond).collect()] == [ts("2025-11-30 18:30:00")]
    shifted = local_date("t", 330).between(F.lit(date(2025, 12, 1)), F.lit(date(2025, 12, 1)))
    assert df.filter(shifted).count() == df.filter(cond).count()


def test_sargable_range_equals_shifted_predicate_on_random_times(spark):
    rnd = random.Random(7)
    base = datetime(2025, 10, 1)
    rows = [(base + timedelta(seconds=rnd.randrange(0, 90 * 86400)),) for _ in range(3000)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    lo, hi = date(2025, 10, 20), date(2025, 11, 10)
    a = df.filter(P.local_date_between("t", lo, hi, 330)).count()
    b = df.filter(local_date("t", 330).between(F.lit(lo), F.lit(hi))).count()
    assert a == b > 0


def test_bucket_edges(spark):
    ages = [-1, 0, 7, 8, 14, 15, 21, 22, 30, 31, None]
    df = spark.createDataFrame([(a,) for a in ages], "a int")
    got = [(r.a, r.o, r.r) for r in df.select("a", age_bucket("a", C.OPEN_BUCKETS).alias("o"),
                                                 age_bucket("a", C.RA_BUCKETS).alias("r")).collect()]
    assert got == [
        (-1, "21+ days", "30+ days"), (0, "0-7 days", "0-7 days"), (7, "0-7 days", "0-7 days"),
        (8, "8-14 days", "8-14 days"), (14, "8-14 days", "8-14 days"), (15, "15-21 days", "15-21 days"),
        (21, "15-21 days", "15-21 days"), (22, "21+ days", "22-30 days"), (30, "21+ days", "22-30 days"),
        (31, "21+ days", "30+ days"), (None, "21+ days", "30+ days")]
    ranks = df.select(bucket_rank(age_bucket("a", C.RA_BUCKETS), C.RA_BUCKETS).alias("k")).collect()
    assert [r.k for r in ranks] == [5, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_not_deleted_drops_null_flag(spark):
    df = spark.createDataFrame([(1, False), (2, True), (3, None)], "id int, f boolean")
    assert [r.id for r in P.not_deleted(df, "f").collect()] == [1]


def test_json_fields(spark):
    rows = [('{"nas_id": 12}',), ('{"nas_id": "34"}',), ('{"nas_id": 12.5}',), ('{"nas_id": null}',),
            ("{}",), ("not json",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    got = [r.n for r in df.select(jsonops.number("s", "nas_id").alias("n")).collect()]
    assert got == [12, 34, 13, None, None, None, None]
    bad = df.select(jsonops.is_bad("s").alias("b")).collect()
    assert [r.b for r in bad] == [False, False, False, False, False, True, False]
    assert existing_keys(df, jsonops.number("s", "nas_id"), "nas_id").count() == 3


def test_rolling_is_rows_not_days(spark):
    days = [date(2025, 11, d) for d in (1, 2, 3, 5, 6, 8, 9, 10)]  # 4th and 7th missing
    df = spark.createDataFrame([(d, 1, 2) for d in days], "d date, s long, t long")
    out = rolling_sums(df, "d", ["s", "t"], 7).orderBy("d").collect()
    assert [r.s_roll for r in out] == [1, 2, 3, 4, 5, 6, 7, 7]
    first = out[0]
    assert first.s_roll == first.s  # first window row = the day itself


def test_pct_zero_and_rounding(spark):
    df = spark.createDataFrame([(5, 16), (0, 0), (None, 3), (1, 8)], "n long, d long")
    got = df.select(pct("n", "d").alias("p"), pct("n", "d", on_zero="one").alias("q"),
                    pct("n", "d", 1, half_up=True).alias("u")).collect()
    assert [r.p for r in got] == [31.2, None, 0.0, 12.5]   # 31.25 -> half-even 31.2
    assert [r.q for r in got] == [31.2, 0.0, 0.0, 12.5]
    assert got[0].u == 31.3


def _trend(spark, rows):
    df = spark.createDataFrame(rows, "w3 double, w2 double, w1 double")
    t, d = alerts.trend(["w3", "w2", "w1"])
    return [(r.t, r.d) for r in df.select(t.alias("t"), d.alias("d")).collect()]


def test_trend_branches(spark):
    rows = [(None, None, 5.0), (10.0, None, 20.0), (0.0, None, 20.0), (100.0, 102.9, None),
            (100.0, 103.0, None), (None, 100.0, 97.0), (1.0, 2.0, 2.0)]
    assert _trend(spark, rows) == [("-", "neutral"), ("Up", "up"), ("Flat", "neutral"), ("Flat", "neutral"),
                                   ("Up", "up"), ("Down", "down"), ("Flat", "neutral")]


def test_vs_baseline_branches(spark):
    rows = [(31.6, 29.2, True), (6.5, 10.9, True), (12.9, 9.5, False), (5.0, 0.0, True), (-1.0, 0.0, True),
            (None, 3.0, True), (3.0, None, True), (3.0, 3.0, False), (3.0, 3.0, True)]
    df = spark.createDataFrame(rows, "c double, b double, h boolean")
    t, d = alerts.vs_baseline("c", "b", F.col("h"))
    got = [(r.t, r.d) for r in df.select(t.alias("t"), d.alias("d")).collect()]
    assert got == [("+8.2%", "good"), ("-40.4%", "bad"), ("+35.8%", "bad"), ("+0%", "good"), ("0%", "bad"),
                   ("-", "neutral"), ("-", "neutral"), ("+0.0%", "bad"), ("+0.0%", "good")]


def test_threshold_and_pickup_signals(spark):
    rows = [("0-7 days", 99999), ("8-14 days", 2000), ("8-14 days", 2001), ("15-21 days", 501),
            ("15-21 days", 1001), ("21+ days", 10), ("21+ days", 11), ("21+ days", 51)]
    df = spark.createDataFrame(rows, "b string, n long")
    got = [r.s for r in df.select(alerts.threshold_signal("b", "n", C.OPEN_SIGNAL_RULES).alias("s")).collect()]
    assert got == ["good", "neutral", "warn", "warn", "bad", "good", "warn", "bad"]
    ra = [("0-7 days", 5000), ("15-21 days", 1001), ("22-30 days", 201), ("22-30 days", 501),
          ("30+ days", 100), ("30+ days", 101), ("30+ days", 301)]
    df = spark.createDataFrame(ra, "b string, n long")
    got = [r.s for r in df.select(alerts.threshold_signal("b", "n", C.RA_SIGNAL_RULES).alias("s")).collect()]
    assert got == ["neutral", "warn", "warn", "bad", "neutral", "warn", "bad"]
    p = spark.createDataFrame([(31.0,), (30.0,), (15.0,), (14.0,), (0.0,), (None,)], "p double")
    t, d = alerts.pickup_verdict("p")
    got = [(r.t, r.d) for r in p.select(t.alias("t"), d.alias("d")).collect()]
    assert got == [("31% picked", "good"), ("30% picked", "neutral"), ("15% picked", "neutral"),
                   ("14% picked", "bad"), ("0% picked", "bad"), ("-", "neutral")]


def test_last_events_equals_lead_is_null(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(40):
        for _ in range(rnd.randrange(1, 6)):
            t = None if rnd.random() < 0.15 else datetime(2025, 1, 1) + timedelta(hours=rnd.randrange(0, 30))
            rows.append((k % 13 if k < 39 else None, t, rnd.randrange(0, 3)))
    df = spark.createDataFrame(rows, "k long, t timestamp_ntz, e int").withColumn("rid", F.monotonically_increasing_id())
    by_lead = next_event(df, "k", "t", tie_cols=["e", "rid"], out="nx").filter(F.col("nx").isNull())
    by_top = last_events(df, "k", "t", tie_cols=["e", "rid"])
    assert sorted(r.rid for r in by_lead.collect()) == sorted(r.rid for r in by_top.collect())


def test_first_after_matches_brute_force(spark):
    rnd = random.Random(11)
    base = datetime(2025, 3, 1)
    left = [(i, f"D{rnd.randrange(6)}" if rnd.random() > 0.05 else None,
             base + timedelta(minutes=rnd.randrange(0, 20 * 1440)) if rnd.random() > 0.05 else None)
            for i in range(400)]
    right = [(f"D{rnd.randrange(6)}", base + timedelta(minutes=rnd.randrange(0, 25 * 1440))) for _ in range(120)]
    right += [(left[0][1], left[0][2])]  # equal time is not "after"
    ldf = spark.createDataFrame(left, "i long, k string, t timestamp_ntz")
    rdf = spark.createDataFrame(right, "k string, t timestamp_ntz")
    got = {r.i: r.nx for r in first_after(ldf, rdf, "k", "k", "t", "t", "nx").collect()}
    want = {}
    for i, k, t in left:
        cands = [rt for rk, rt in right if k is not None and t is not None and rk == k and rt > t]
        want[i] = min(cands) if cands else None
    assert got == want


def test_match_counts_equal_fanout_join(spark):
    left = spark.createDataFrame([(1,), (2,), (3,), (3,)], "id long")
    right = spark.createDataFrame([(1, 1), (1, 0), (1, None), (2, 0), (9, 1)], "k long, s int")
    fan = left.join(right, left.id == right.k, "left")
    want = (fan.count(), fan.filter(F.col("s") == 1).count())
    c = match_counts(right, "k", {"_one": F.col("s") == 1})
    j = left.join(c, left.id == c._mk, "left")
    got = j.agg(F.sum(F.coalesce("_n", F.lit(1))).alias("rows"), F.sum(F.coalesce("_one", F.lit(0))).alias("one")).first()
    assert (got.rows, got.one) == want


def test_exists_flag_never_duplicates(spark):
    left = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "d string")
    keys = spark.createDataFrame([("b",), ("c",)], "d string")
    out = exists_flag(left, keys, "d", "d", "picked").collect()
    assert len(out) == 4
    assert sorted((r.d or "", r.picked) for r in out) == [("", False), ("a", False), ("b", True), ("b", True)]


def test_zero_fill_and_total(spark):
    df = spark.createDataFrame([("8-14 days", 3), ("21+ days", 4)], "age_bucket string, n long")
    z = zero_fill(df, C.OPEN_BUCKETS, ["n"]).orderBy("bucket_rank").collect()
    assert [(r.age_bucket, r.n) for r in z] == [("0-7 days", 0), ("8-14 days", 3), ("15-21 days", 0), ("21+ days", 4)]
    t = {r.age_bucket: r.n for r in with_total(df, "age_bucket", ["n"]).collect()}
    assert t == {"8-14 days": 3, "21+ days": 4, "Total": 7}


def test_last_full_weeks():
    w = last_full_weeks(date(2001, 8, 2), 3)
    assert [(lbl, s.isoformat(), e.isoformat()) for lbl, s, e in w] == [
        ("W-3", "2001-07-09", "2001-07-15"), ("W-2", "2001-07-16", "2001-07-22"), ("W-1", "2001-07-23", "2001-07-29")]
    assert last_full_weeks(date(2001, 7, 30), 1)[0][1] == date(2001, 7, 23)  # a Monday as-of



def test_iso_date_and_bad_json_count(spark):
    from ticketflow.functions.timeops import iso_date
    from ticketflow.operators.checks import bad_json
    df = spark.createDataFrame([("2025-11-03T10:00:00",), ("2025-11-03",), (None,)], "s string")
    assert [r.d for r in df.select(iso_date("s").alias("d")).collect()] == [date(2025, 11, 3), date(2025, 11, 3), None]
    j = spark.createDataFrame([("{}",), ("oops",), (None,), ('{"a": 1}',)], "s string")
    assert bad_json(j, "s").first().bad_json == 1


def test_weekly_operators_over_days_present(spark):
    from ticketflow.operators import weekly as W
    days = [(date(2025, 11, 3), 10, 2, 8), (date(2025, 11, 4), 11, 1, 4),   # week of 3 Nov, 2 days present
            (date(2025, 11, 12), 4, 0, 0)]                                  # week of 10 Nov, den 0
    df = spark.createDataFrame(days, "d date, v long, n long, t long")
    avg = {r.week_start: r.a for r in W.avg_per_day(df, "d", "v", "a").collect()}
    assert avg == {date(2025, 11, 3): 10.0, date(2025, 11, 10): 4.0}     # 10.5 -> half-even 10
    rat = {r.week_start: r.p for r in W.ratio(df, "d", "n", "t", "p").collect()}
    assert rat == {date(2025, 11, 3): 25.0, date(2025, 11, 10): None}
    assert W.baseline_avg(df, "d", "v", date(2026, 1, 1), date(2026, 1, 31)).first().baseline is None
    tot = W.total(spark.createDataFrame([(1, None), (2, 5), (2, 6)], "w int, x long"), ["w"], "x", "s")
    assert {r.w: r.s for r in tot.collect()} == {1: None, 2: 11}
    per = W.slot_sums(df, "d", ["v"], date(2025, 11, 20), 2, (date(2025, 11, 1), date(2025, 11, 3)))
    assert {r.slot: (r._days, r.v) for r in per.collect()} == {2: (2, 21), 1: (1, 4), 0: (1, 10)}


def test_exact_median_equals_percentile(spark):
    from ticketflow.operators.agg import exact_median
    rnd = random.Random(13)
    for n in (1, 2, 7, 1000, 1001):
        vals = [rnd.randrange(-5000, 200000) for _ in range(n)] + [None]
        df = spark.createDataFrame([(x,) for x in vals], "v long")
        want = df.agg(F.median("v").alias("m")).first().m
        assert exact_median(df, "v", 3600).first().median == want
    empty = spark.createDataFrame([], "v long")
    assert exact_median(empty, "v").first().median is None


def test_exact_median_by_group(spark):
    import random
    from statistics import median

    from ticketflow.operators.agg import exact_median
    rnd = random.Random(6)
    rows = [(rnd.choice(["hot"] * 20 + ["a", "b", None]), rnd.choice([None, rnd.randrange(-5000, 20_000)])) for _ in range(3000)]
    rows += [("one", 7), ("two", 7), ("two", 8), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v long").repartition(5)
    got = {r.g: r.m for r in exact_median(df, "v", 600, "m", by=["g"]).collect()}
    want: dict = {}
    for g, v in rows:
        want.setdefault(g, []).extend([v] if v is not None else [])
    assert {g: m for g, m in got.items() if m is not None} == {g: float(median(v)) for g, v in want.items() if v}
