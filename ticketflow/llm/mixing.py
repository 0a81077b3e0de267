"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed by (source, language, topic) cell.  The cells' weights are
raked: scaled so that each source has its target share of tokens, then each
language, then each topic, over and over until all three marginals hold at once.
A document's rate is its cell's raked weight over the cell's tokens, on the scale
that meets the token budget: the copies of it the mixture holds on average.  Its
whole copies are taken and the remainder is drawn by a hash of the id, so a rerun
draws the same ones, and the expected tokens meet all targets also where a cell
has fewer tokens than its share.  ``probability`` and ``kept`` are the draw without
repeats: rates capped at 1 and raised by one scale to the same budget, which falls
short of the targets of scarce cells.  Targets that the raked weights miss are warned of.

Defined results: a null source, language or topic is the category ''; null and
empty texts have 0 tokens, belong to their cell and share its probability; cells
without a token get probability 0; repeated rows share one draw; a target that no document can meet is left out and
the others are scaled up; an empty table gives no rows.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, stored

#: Without given targets a marginal's shares are its token shares to this power (1: as they are, 0: equal).
TEMPER = 0.7
#: Share of all tokens to sample.
BUDGET = 0.5
TOLERANCE, MAX_ROUNDS = 1e-4, 60


def tokens(text: str) -> Column:
    """Number of words (runs of characters other than space and \\x09-\\x0D)."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def topic(text: str) -> Column:
    """A coarse topic by the shape of a text, for tables that have no topic column."""
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.length(t)
    marks = F.regexp_count(t, F.lit("[#*$%&]"))
    bars = F.regexp_count(t, F.lit("[|]"))
    return (F.when(bars * 40 > n, "table").when(marks * 40 > n, "symbols")
            .when(n < 400, "note").when(n < 4000, "prose").otherwise("long"))


def _targets(cells: DataFrame, dim: str, given: dict | None, temper: float) -> DataFrame:
    """(dim, goal): shares of tokens that sum to 1 over the categories that have any."""
    have = cells.groupBy(dim).agg(F.sum("tokens").alias("n")).where(F.col("n") > 0)
    if given is None:
        raw = have.select(dim, F.pow(F.col("n").cast("double"), F.lit(temper)).alias("raw"))
    else:
        rows = [(k if k is not None else "", float(v)) for k, v in given.items() if v > 0]
        raw = have.join(cells.sparkSession.createDataFrame(rows, f"{dim} string, raw double"), dim).select(dim, "raw")
    total = raw.agg(F.sum("raw")).first()[0]  # null: no category has a token, so there is no row to divide
    return raw.select(dim, (F.col("raw") / F.lit(total).cast("double")).alias(f"goal_{dim}"))


def rake(cells: DataFrame, dims: list[str], targets: dict[str, dict | None] | None = None, temper: float = TEMPER,
         tolerance: float = TOLERANCE, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``cells`` (dims, tokens) with ``weight``: raked shares that sum to 1, whose marginals are the targets.

    Every round is one job over the cells, written to the shared folder; only
    the largest deviation comes to the driver."""
    goals = {d: _targets(cells, d, (targets or {}).get(d), temper) for d in dims}
    now = cells.withColumn("weight", F.col("tokens").cast("double"))
    for d in dims:
        now = now.join(goals[d], d, "left")
    now = stored(now.withColumn("weight", F.when(
        sum((F.col(f"goal_{d}").isNull().cast("int") for d in dims), F.lit(0)) > 0, 0.0).otherwise(F.col("weight"))), "cells")
    for _ in range(max_rounds):
        now = now.withColumn("_worst", F.lit(0.0))
        for d in dims:
            have = now.groupBy(d).agg(F.sum("weight").alias("have"))
            step = F.when(F.col("have") > 0, F.col(f"goal_{d}") / F.col("have")).otherwise(0.0)
            moved = F.when(F.col("weight") > 0, F.abs(step - 1)).otherwise(0.0)
            now = (now.join(have, d).withColumn("_worst", F.greatest("_worst", moved))
                   .withColumn("weight", F.col("weight") * step).drop("have"))
        now = stored(now, "raked")
        off = now.agg(F.max("_worst")).first()[0]
        if off is None or off <= tolerance:
            break
    for d in dims:
        _report(now, goals[d], d, (targets or {}).get(d), tolerance)
    return now.select(*dims, "tokens", "weight")


def _report(raked: DataFrame, goals: DataFrame, dim: str, given: dict | None, tolerance: float) -> None:
    """Warn of the marginal's targets that the weights miss, and of given ones without a token."""
    have = raked.groupBy(dim).agg(F.sum("weight").alias("have"))
    gap = F.abs(F.coalesce("have", F.lit(0.0)) / F.col(f"goal_{dim}") - 1)
    n, missed, worst = goals.join(have, dim, "left").agg(
        F.count(F.lit(1)), F.count(F.when(gap > 2 * tolerance, 1)), F.max(gap)).first()
    if missed:
        warnings.warn(f"mixture: {missed} of {n} targets of {dim} missed, by up to {worst:.2%} of the target", stacklevel=3)
    left_out = sum(v > 0 for v in (given or {}).values()) - n
    if left_out > 0:
        warnings.warn(f"mixture: {left_out} targets of {dim} have no tokens and are left out", stacklevel=3)


def calibrated(raked: DataFrame, budget: float = BUDGET) -> DataFrame:
    """``raked`` with ``probability``: min(1, scale * weight / tokens), the scale such that the
    expected tokens are ``budget`` of all (or all that have weight, if that is less), and
    ``copies_expected``: weight / tokens on the scale that needs no cap to meet the budget."""
    rows = stored(raked.withColumn("rate", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)),
                  "rates")
    total, mass = rows.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    goal, scale, before = budget * total, float(budget * total), -1
    while True:  # cells at probability 1 only ever grow in number
        full = F.col("rate") * F.lit(scale) >= 1
        got = rows.agg(F.coalesce(F.sum(F.when(full, F.col("tokens"))), F.lit(0)).alias("full"),
                       F.coalesce(F.sum(F.when(full, 1)), F.lit(0)).alias("cells"),
                       F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open")).first()
        if got["cells"] == before or got["open"] <= 0 or got["full"] >= goal:
            break
        before, scale = got["cells"], max(scale, (goal - got["full"]) / got["open"])
    return rows.select(*[c for c in rows.columns if c != "rate"],
                       F.least(F.lit(1.0), F.col("rate") * F.lit(scale)).alias("probability"),
                       (F.col("rate") * F.lit(budget * total / mass if mass else 0.0)).alias("copies_expected"))


def _drawn(id_col: str, probability: Column, seed: int = 17) -> Column:
    """Whether the id's hash, as a number in [0, 1), is below the probability."""
    u = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(seed)), 11) / F.lit(2.0**53)
    return u < probability


def _copies(id_col: str, expected: str) -> Column:
    """The whole copies, and one more if the remainder is drawn."""
    whole = F.floor(expected)
    return whole + _drawn(id_col, F.col(expected) - whole).cast("long")


def mixed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
          topic_col: Column | None = None, targets: dict | None = None, temper: float = TEMPER, budget: float = BUDGET,
          keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (the id by default) with _source, _lang, _topic, _tokens, weight (the row's
    share of the mixture before sampling), probability and kept (the draw without repeats),
    copies_expected and copies (the draw that meets the targets)."""
    keep = [id_col] if keep is None else keep
    dims = ["_source", "_lang", "_topic"]
    rows = docs.select(*[F.col(c) for c in keep], *([] if id_col in keep else [F.col(id_col)]),
                       F.coalesce(F.col(source), F.lit("")).alias("_source"),
                       F.coalesce(F.col(lang), F.lit("")).alias("_lang"),
                       F.coalesce(topic(text) if topic_col is None else topic_col, F.lit("")).alias("_topic"),
                       tokens(text).alias("_tokens"))
    if text not in keep:  # a few numbers a row: the texts are read once
        rows = stored(rows, "tokens")
    cells = stored(rows.groupBy(*dims).agg(F.sum("_tokens").alias("tokens")), "mixture")
    by_dim = {f"_{k}": v for k, v in (targets or {}).items()}
    p = calibrated(rake(cells, dims, by_dim, temper), budget)
    w = F.when(F.col("tokens") > 0, F.col("weight") * F.col("_tokens") / F.col("tokens")).otherwise(0.0)
    return rows.join(p, dims).select(*keep, *dims, "_tokens", w.alias("weight"), "probability",
                                     _drawn(id_col, F.col("probability")).alias("kept"),
                                     "copies_expected", _copies(id_col, "copies_expected").alias("copies"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(read(spark, sf_dir, "documents")).select(
        "doc_id", F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"),
        F.col("_tokens").alias("tokens"), "weight", "probability", "kept", "copies_expected", "copies")


def sample(docs: DataFrame, **how) -> DataFrame:
    """The drawn rows of ``docs``, one for each copy, with weight and the probability with which
    this copy is drawn (1: a whole copy) beside their columns."""
    named = {c: f"_in{i}" for i, c in enumerate(docs.columns)}  # free of the names used inside
    inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in named.items()])
    roles = {k: named[how.pop(k, v)] for k, v in (("id_col", "doc_id"), ("text", "text"), ("source", "source"),
                                                  ("lang", "lang"))}
    out = mixed(inner, keep=list(named.values()), **roles, **how).where("copies > 0")
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).withColumn(
        "probability", F.least(F.lit(1.0), F.col("copies_expected") - (F.col("_copy") - 1)))
    extra = [c for c in ("weight", "probability") if c not in docs.columns]
    return out.select(*[F.col(n).alias(c) for c, n in named.items()], *extra)


QUERIES = {"op10_mixing": op10_mixing}
