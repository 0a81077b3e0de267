"""Secret scan with corpus-wide ownership frequency.

Every text is scanned for credential-like strings (candidates).  Candidates are
hashed, and for each hash the distinct repositories, owners and texts that hold it
are counted over all rows of the corpus.  Repositories, and with ``each_text_once``
(as the query and the pipeline have it) owners, weigh no more than the texts, so that
copies of one document make no example: one that many owners share, or that is in
different texts of many repositories, is a copied example; one that few own and few
repositories hold and that looks random is a live credential.  Three kinds are
spans by their pattern alone (``assign``, ``access``, ``hex``); a fourth,
``owned``, is any long mixed string that the ownership count finds live.

Defined results: a null text is empty; a null repository or owner counts as one
of its own (''); repeated rows are scanned each and count once for a repository;
texts of any length are scanned whole; an empty table gives no rows; columns
that are not named are carried or ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read, stored, strings

KINDS = ("assign", "access", "hex", "owned")
#: Held by so many owners or more, a candidate is a copied example.
MIN_OWNERS = 3
#: Held by different texts of so many repositories or more, it is one also under a single owner.
MIN_REPOS = 10

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.A | re.I)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_LONG = re.compile(r"[A-Za-z0-9+/_-]{20,}")
#: Words of which one is in every ``assign`` span: most texts have none.
_SIGNS = re.compile(r"passw|secret|token|api_?key", re.A | re.I)


def entropy(value: str) -> float:
    """Bits a character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def looks_random(value: str) -> bool:
    return entropy(value) >= min(3.0, 0.75 * math.log2(max(len(value), 2)))


def candidates(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) in code points, by start and kind."""
    out = []
    if _SIGNS.search(text):
        out += [(m.start(), m.end(), "assign", m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access", m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), m.end(), "hex", m[0]) for m in _HEX.finditer(text)]
    base = sorted((a, b) for a, b, *_ in out)
    for m in _LONG.finditer(text):
        v = m[0]
        if any(c.isdigit() for c in v) and any("a" <= c <= "z" for c in v) and any("A" <= c <= "Z" for c in v) \
                and entropy(v) >= 3.5 and not any(a < m.end() and m.start() < b for a, b in base):
            out.append((m.start(), m.end(), "owned", v))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                                   T.StructField("kind", T.IntegerType()), T.StructField("value", T.LongType()),
                                   T.StructField("random", T.BooleanType())]))
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()),
                                   ("value", pa.int64()), ("random", pa.bool_())]))


def _found(text: str) -> list[dict]:
    return [{"start": a, "end": b, "kind": KINDS.index(k), "random": looks_random(v),
             "value": xxhash.xxh64_intdigest(v.encode(), 1) - (1 << 63)} for a, b, k, v in candidates(text)]


def scan(docs: DataFrame, text: str, keep: list[str], only_found: bool | None = None) -> DataFrame:
    """``keep`` columns, ``_row`` (unique as long as the result is stored), ``_spans`` and, beside
    any, ``_content`` (a hash of the whole text).

    ``only_found`` True or False keeps the rows with or without candidates.
    """
    fields = [docs.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField("_row", T.LongType()), T.StructField("_spans", _SPANS),
                           T.StructField("_content", T.LongType())])

    def work(batches):
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            texts = strings(b.column(0)).to_pylist()
            spans = [_found(t) for t in texts]
            content = [xxhash.xxh64_intdigest(t.encode()) - (1 << 63) if s else None for t, s in zip(texts, spans)]
            rows = range(row, row + len(spans))
            row += len(spans)
            out = pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(rows, pa.int64()),
                                              pa.array(spans, _ARROW_SPANS), pa.array(content, pa.int64())], schema.names)
            yield out if only_found is None else out.filter(pa.array([bool(s) == only_found for s in spans]))

    return docs.select(F.col(text).alias("_text"), *[F.col(c) for c in keep]).mapInArrow(work, schema)


def ownership(found: DataFrame, repo: str, owner: str) -> DataFrame:
    """(value, all_repos, all_owners, texts): how many distinct repositories, owners and texts hold
    each candidate, over all rows of the corpus, copies included.

    Distinct counts in steps with partial sums: a string that a third of all texts hold is
    spread by what is counted before it is summed."""
    held = found.select(F.explode(F.array_distinct("_spans.value")).alias("value"), "_content",
                        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
                        F.coalesce(F.col(repo).cast("string"), F.lit("")).alias("repo"))
    return held.groupBy("value").agg(F.count_distinct("repo").alias("all_repos"),
                                     F.count_distinct("owner").alias("all_owners"),
                                     F.count_distinct("_content").alias("texts"))


def judged(found: DataFrame, repo: str, owner: str, min_owners: int = MIN_OWNERS,
           each_text_once: bool = False, min_repos: int = MIN_REPOS) -> DataFrame:
    """(_row, _live): for each stored row with candidates, which of them (by start and kind) are live.

    Copies of one text are no evidence of an example: repositories count up to the number of
    texts that hold the candidate, with ``each_text_once`` owners too."""
    owners = F.least("all_owners", "texts") if each_text_once else F.col("all_owners")
    owned = ownership(found, repo, owner).withColumn("repos", F.least("all_repos", "texts")).withColumn("owners", owners)
    spans = found.select("_row", F.explode("_spans").alias("s")).select("_row", "s.*")
    example = (F.col("owners") >= min_owners) | (F.col("repos") >= min_repos)
    verdict = spans.join(owned, "value").select(
        "_row", F.struct("start", "kind", "end", (~example & F.col("random")).alias("live"),
                         "owners", "repos", example.alias("example"), "all_repos", "all_owners", "texts").alias("v"))
    return verdict.groupBy("_row").agg(F.sort_array(F.collect_list("v")).alias("_live"))


def secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text", repo: str = "doc_id", owner: str = "source",
            min_owners: int = MIN_OWNERS, each_text_once: bool = False, min_repos: int = MIN_REPOS) -> DataFrame:
    """One row for each text: its spans by pattern, those that the ownership count
    adds, how many are live or copied examples, and for each candidate (by start and kind)
    the repositories that weigh and all repositories, owners and texts that hold it."""
    asked, id_name = dict.fromkeys([id_col, repo, owner]), id_col
    private = {c: f"_in{i}" for i, c in enumerate(asked)}  # free of the names used inside
    inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in private.items()], F.col(f"`{text}`").alias("_whole"))
    id_col, repo, owner = private[id_col], private[repo], private[owner]
    rows = stored(scan(inner, "_whole", list(private.values())), "secrets")
    found = rows.where(F.size("_spans") > 0)
    full = rows.join(judged(found, repo, owner, min_owners, each_text_once, min_repos), "_row", "left")
    live = F.coalesce("_live", F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint,live:boolean,"
                                      "owners:bigint,repos:bigint,example:boolean,all_repos:bigint,"
                                      "all_owners:bigint,texts:bigint>>)"))
    base = F.filter(live, lambda s: s["kind"] < 3)
    kept = F.filter(live, lambda s: (s["kind"] < 3) | s["live"])

    def joined(spans):
        name = F.array(*[F.lit(k) for k in KINDS])
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(cond):
        return F.size(F.filter(live, cond)).cast("long")

    def is_kind(k):
        return lambda s: s["kind"] == k

    def each(name):
        return F.transform(live, lambda s: s[name])
    return full.select(
        F.col(id_col).alias(id_name),
        *[count(is_kind(k)).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(kept).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: s["example"]).alias("n_example"),
        *[each(c).alias(c) for c in ("repos", "all_repos", "all_owners", "texts")])


def redact(docs: DataFrame, text: str = "text", repo: str = "doc_id", owner: str = "source", n_chars: str = "n_chars",
           min_owners: int = MIN_OWNERS, mark: str = "<secret>", each_text_once: bool = False,
           min_repos: int = MIN_REPOS) -> DataFrame:
    """``docs`` with every live credential replaced by ``mark`` (overlapping spans by one),
    and ``n_chars``, if there is such a column, counted anew.  All rows stay."""
    private = {c: f"_in{i}" for i, c in enumerate(docs.columns)}  # free of the names used inside
    names, docs = docs.columns, docs.select(*[F.col(f"`{c}`").alias(n) for c, n in private.items()])
    text, repo, owner, n_chars = private[text], private[repo], private[owner], private.get(n_chars)
    cols = docs.columns
    found = stored(scan(docs, text, cols, True), "secrets")
    rest = scan(docs, text, cols, False).select(*cols)
    full = found.join(judged(found, repo, owner, min_owners, each_text_once, min_repos), "_row")
    live = F.filter("_live", lambda s: s["live"])
    schema = docs.schema

    def work(batches):
        at = cols.index(text)
        for b in batches:
            out = []
            for t, spans in zip(b.column(at).to_pylist(), b.column(len(cols)).to_pylist()):
                pieces, done = [], 0
                for s in spans:
                    if s["start"] >= done:
                        pieces += [t[done:s["start"]], mark]
                    done = max(done, s["end"])
                out.append("".join([*pieces, t[done:]]) if spans else t)
            yield pa.RecordBatch.from_arrays([pa.array(out, b.schema.field(at).type) if i == at else b.column(i)
                                              for i in range(len(cols))], cols)

    cut = full.select(*cols, live.alias("_cut")).mapInArrow(work, schema)
    if n_chars in cols:
        cut = cut.withColumn(n_chars, F.length(text).cast(schema[n_chars].dataType))
    return cut.unionByName(rest).toDF(*names)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(read(spark, sf_dir, "documents"), each_text_once=True)


QUERIES = {"op3_secrets": op3_secrets}
