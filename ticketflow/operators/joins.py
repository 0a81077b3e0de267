"""Join shapes used by the metrics.

Physical strategy is left to Catalyst + AQE: small sides are broadcast only when
runtime statistics prove them small (``spark.sql.adaptive.autoBroadcastJoinThreshold``),
otherwise the join is a shuffled sort-merge join whose skewed partitions AQE
splits.  Where the reference's join multiplies rows only to count them, the
helpers here count first and multiply counts, so no pair is ever materialised.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_latest(left: DataFrame, latest: DataFrame, left_key: str, right_key: str,
                cols: Sequence[str]) -> DataFrame:
    """LEFT JOIN ``latest`` (one row per key) ON left_key = right_key; adds ``cols``.
    The right side is unique per key, so the join never multiplies left rows."""
    r = latest.select(F.col(right_key).alias("_rk"), *cols)
    return left.join(r, left[left_key] == r["_rk"], "left").drop("_rk")


def left_filtered(left: DataFrame, right: DataFrame, on: Column | str | list,
                  right_cond: Column | None = None) -> DataFrame:
    """LEFT JOIN right ON key AND <condition on right only>: the condition is
    applied to the right input before the join (never to the joined rows)."""
    if right_cond is not None:
        right = right.filter(right_cond)
    return left.join(right, on, "left")


def inner_filtered(left: DataFrame, right: DataFrame, on, right_cond: Column | None = None) -> DataFrame:
    if right_cond is not None:
        right = right.filter(right_cond)
    return left.join(right, on, "inner")


def inner_fanout(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Plain inner join that keeps every matching pair (counts depend on it)."""
    return left.join(right, on, "inner")


def missing_followups(left: DataFrame, right_keys: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """LEFT JOIN .. WHERE right.key IS NULL, written as the anti join it is."""
    return left.join(right_keys, left[left_key] == right_keys[right_key], "left_anti")


def exists_flag(left: DataFrame, right_keys: DataFrame, left_key: str, right_key: str,
                name: str) -> DataFrame:
    """Adds boolean ``name``: does ``left_key`` occur among ``right_keys``?
    ``right_keys`` must already be distinct, so no left row is duplicated."""
    r = right_keys.select(F.col(right_key).alias("_ek")).withColumn(name, F.lit(True))
    return (left.join(r, left[left_key] == r["_ek"], "left").drop("_ek")
            .withColumn(name, F.coalesce(F.col(name), F.lit(False))))


def missing_or(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
               cond: Column) -> DataFrame:
    """Rows of LEFT JOIN right where no right row matched or ``cond`` holds on
    the matched right row (fan-out kept)."""
    j = left.join(right, left[left_key] == right[right_key], "left")
    return j.filter(right[right_key].isNull() | cond)


def match_counts(right: DataFrame, key: str, measures: dict[str, Column]) -> DataFrame:
    """Per key: number of right rows (``_n``) and conditional counts.

    Joining this to the left side reproduces the counts of a fan-out LEFT/INNER
    join without emitting the pairs: a left row matched by n right rows
    contributes n rows, of which ``count_if(cond)`` satisfy cond.  Partial
    aggregation runs map-side, so a hot key is collapsed before the shuffle.
    """
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count_if(c).alias(n) for n, c in measures.items()]
    return right.groupBy(F.col(key).alias("_mk")).agg(*aggs)


#: Words of a key sketch: 2^20 x 64 bits, so at most 2^20 rows of two numbers are broadcast, however many keys there are.
SKETCH_WORDS = 1 << 20


def key_sketch(keys: DataFrame, key: str, words: int = SKETCH_WORDS) -> DataFrame:
    """Bitmap of the hashed non-NULL keys as rows (``_word``, ``_bits``), ``words`` at most.
    The bits are or-ed map-side, so a hot key leaves each map task as one row."""
    word, bit = _sketch_place(key, words)
    return keys.filter(F.col(key).isNotNull()).groupBy(word.alias("_word")) \
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("_bits"))


def _sketch_place(key: str, words: int) -> tuple[Column, Column]:
    h = F.xxhash64(F.col(key))
    return F.pmod(F.shiftright(h, 6), F.lit(words).cast("bigint")), F.pmod(h, F.lit(64).cast("bigint")).cast("int")


def only_keys_of(df: DataFrame, key: str, keys: DataFrame, keys_key: str, words: int = SKETCH_WORDS) -> DataFrame:
    """``df`` without most rows whose ``key`` does not occur in ``keys``: a filter ahead of a join on that
    key, which stays exact, since every row whose key does occur is kept.

    A semi join on the keys themselves would shuffle all rows of a hot key to one task
    before anything is combined.  Here the keys become a bitmap of bounded size that is
    broadcast, so the rows are dropped in the scan's own tasks, below the partial
    group limit or partial aggregate that follows.  With n distinct keys a share of
    about 1 - exp(-n / (64 x words)) of the other rows stays: 1.5 % at a million, 26 % at
    twenty million; beyond that the filter only helps less.  Rows with a NULL key match nothing and may go or stay.
    """
    if df.schema[key].dataType != keys.schema[keys_key].dataType:
        raise TypeError(f"{key} and {keys_key} are of different types and would hash differently")
    word, bit = _sketch_place(key, words)
    held = (word == F.col("_word")) & (F.getbit(F.col("_bits"), bit) == 1)
    return df.join(F.broadcast(key_sketch(keys, keys_key, words)), held, "left_semi")


def next_times(times: DataFrame) -> DataFrame:
    """For distinct (``_k``, ``_t``) with ``_r`` (``_t`` where it is an event, else NULL): adds ``_next``, the
    key's first event strictly after ``_t``.  NULL keys are a key; ``_t`` is never NULL.

    A carry runs down three levels, so no task's window grows with the rows of a
    key: a key's hours, then the seconds of one hour with the first event of all
    later hours put behind them, then the distinct instants of one second with the
    first event of all later seconds put behind them.  A window holds the hours of the
    time span, 3,601 seconds or the microseconds of one second at most, however
    many rows fall into a minute.  Frames grow from the newest row, so each is
    one pass; a frame that runs to unbounded following would be quadratic.
    """
    second = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("_t"))
    at = times.withColumn("_s", second)
    seconds = at.groupBy("_k", F.floor(F.col("_s") / 3600).alias("_h"), "_s").agg(F.min("_r").alias("_r"))
    hours = seconds.groupBy("_k", "_h").agg(F.min("_r").alias("_r"))

    def later(by: Sequence[str], order: str) -> Column:
        w = Window.partitionBy(*by).orderBy(F.col(order).desc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
        return F.min("_r").over(w)

    # the carry of a level is one more row of the level below, newer than all of them
    carry = hours.select("_k", "_h", F.lit(None).cast("bigint").alias("_s"), later(["_k"], "_h").alias("_r"))
    carry = seconds.unionByName(carry).select("_k", "_s", later(["_k", "_h"], "_s").alias("_r")).filter(F.col("_s").isNotNull())
    rows = at.unionByName(carry, allowMissingColumns=True)
    return (rows.withColumn("_next", later(["_k", "_s"], "_t")).filter(F.col("_t").isNotNull()).drop("_s"))


#: Halving steps that find a place among the seconds of a day (86,400 at most).
_STEPS = [1 << i for i in range(16, -1, -1)]


def _second(ts: str) -> Column:
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts))


def first_after(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_ts: str, right_ts: str,
                out: str = "next_ts", max_gap: timedelta | None = None) -> DataFrame:
    """For each left row, the earliest right time with the same key strictly
    after the left time (NULL when none, or when it is more than ``max_gap``
    later).  Every left row is kept.

    Events are reduced to the first and last of each second, and those to one sorted
    array a (key, day).  A carry over the days that either side names gives the first event of
    all later days, so a left row finds its answer in one join whose other side is
    unique: a hot key or day is split by AQE, and left rows are shuffled once.  Only rows that lie
    between the first and last event of one second are answered instant by
    instant.  No (left, right) pair is produced and no array holds more than a day's seconds.
    """
    keyed = F.col(left_key).isNotNull() & F.col(left_ts).isNotNull()
    events = right.select(F.col(right_key).alias("_k"), F.col(right_ts).alias("_t")) \
        .filter(F.col("_k").isNotNull() & F.col("_t").isNotNull() & F.col("_t").cast("date").isNotNull())
    # the filter on the date drops nothing: joins on it infer it, and with it here they share one shuffle
    seconds = events.groupBy("_k", F.col("_t").cast("date").alias("_d"), _second("_t").alias("_s")) \
        .agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"))
    days = seconds.groupBy("_k", "_d").agg(F.sort_array(F.collect_list(F.struct("_first", "_last"))).alias("_at"))
    first = F.col("_at")[0]["_first"].alias("_r")
    asked = left.filter(keyed).select(F.col(left_key).alias("_k"), F.col(left_ts).cast("date").alias("_d"),
                                      F.lit(None).cast("timestamp_ntz").alias("_r"))
    w = Window.partitionBy("_k").orderBy(F.col("_d").desc()).rowsBetween(Window.unboundedPreceding, -1)
    spine = asked.unionByName(days.select("_k", "_d", first)).groupBy("_k", "_d").agg(F.min("_r").alias("_r")) \
        .select("_k", "_d", F.col("_r").isNotNull().alias("_has"), F.min("_r").over(w).alias("_later"))
    spine = spine.filter(F.col("_has") | F.col("_later").isNotNull()).join(days, ["_k", "_d"], "left")

    t = F.col(left_ts)
    place = F.aggregate(F.array(*[F.lit(x) for x in _STEPS]), F.lit(0), lambda n, x: F.when(
        (n + x <= F.size("_at")) & (F.get("_at", n + x - 1)["_first"] <= t), n + x).otherwise(n))  # seconds begun by t
    found = left.filter(keyed).join(
        spine.withColumnsRenamed({"_k": "_sk", "_d": "_sd"}),
        (F.col(left_key) == F.col("_sk")) & (t.cast("date") == F.col("_sd")), "left") \
        .withColumn("_n", F.when(F.col("_at").isNotNull(), place)) \
        .withColumn("_in", F.coalesce((F.col("_n") > 0) & (t < F.get("_at", F.col("_n") - 1)["_last"]), F.lit(False))) \
        .filter(~F.col("_in")) \
        .select(*left.columns, F.coalesce(F.get("_at", F.col("_n"))["_first"], F.col("_later")).alias("_an"))

    # rows between two events of one second: few, found by the seconds that hold two events or more
    crowded = seconds.filter(F.col("_first") < F.col("_last")).select(F.struct("_k", "_s").alias("_ks"), "_first", "_last")
    inside = only_keys_of(left.filter(keyed).withColumn("_ks", F.struct(F.col(left_key).alias("_k"), _second(left_ts).alias("_s"))),
                          "_ks", crowded, "_ks")
    inside = inside.join(crowded, "_ks").filter((t >= F.col("_first")) & (t < F.col("_last"))).select(*left.columns)
    near = events.withColumn("_ks", F.struct("_k", _second("_t").alias("_s"))).join(crowded.select("_ks"), "_ks", "left_semi")
    found = found.unionByName(_first_after_instants(inside, near, left_key, left_ts))

    if max_gap is not None:
        found = found.withColumn("_an", F.when(F.col("_an") <= t + F.lit(max_gap), F.col("_an")))
    # rows without a key or time can match nothing and take no part in the shuffles
    return found.withColumnRenamed("_an", out) \
        .unionByName(left.filter(~keyed).withColumn(out, F.lit(None).cast("timestamp_ntz")))


def _first_after_instants(left: DataFrame, events: DataFrame, left_key: str, left_ts: str) -> DataFrame:
    """``left`` with ``_an``, the first of ``events`` (``_k``, ``_t``) strictly after its time: both sides
    become distinct (key, time), ``next_times`` answers those, and the left rows look their instant up."""
    asked = left.select(F.col(left_key).alias("_k"), F.col(left_ts).alias("_t"),
                        F.lit(None).cast("timestamp_ntz").alias("_r"), F.lit(True).alias("_asked"))
    times = asked.unionByName(events.select("_k", "_t", F.col("_t").alias("_r"), F.lit(False).alias("_asked"))) \
        .groupBy("_k", "_t").agg(F.max("_r").alias("_r"), F.max("_asked").alias("_asked"))
    answer = next_times(times).filter(F.col("_asked") & F.col("_next").isNotNull()).select("_k", "_t", F.col("_next").alias("_an"))
    return left.join(answer, (F.col(left_key) == F.col("_k")) & (F.col(left_ts) == F.col("_t")), "left").drop("_k", "_t")
