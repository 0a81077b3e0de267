"""Quality rules with cross-document line frequency.

Each text gets simple counts of its own; besides, its lines are normalised and
hashed, the distinct texts that hold a line are counted for each host, lines in
more than a fixed number of them are taken as boilerplate whatever the host's size, and a text that is left with
too little once they are removed is rejected.  Exact copies of a text count
once for a line: a copied document is not boilerplate.

Defined results: a null or empty text has no words and fails the base rules;
a null host counts as ''; repeated rows are judged each; lines without a word
are ignored; an empty table gives no rows; columns that are not named are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, read, stored, strings, utf8
from .tokens import hashes, pair, spans

#: A line is boilerplate if more distinct texts of its host hold it than this.
MIN_TEXTS = 10
#: A share of the host's distinct texts for callers that want a lower limit on hosts of under MIN_TEXTS / SHARE texts.
SHARE = 0.02
#: Words a text needs, in all and once boilerplate is removed, and the share of its words that must be left.
MIN_WORDS = 50
MIN_LEFT = 0.3

_SPACES = b" \t\n\x0b\x0c\r"
_CONTINUED = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_DIGITS = bytes.maketrans(b"123456789", b"000000000")


def repeat_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, words inside a 3-word window that occurs twice or more) of each text."""
    s, e, first = spans(data, offsets)
    h = hashes(data, s, e, lower=False)
    n = np.diff(first)
    windows = np.maximum(n - 2, 0)
    owner = np.repeat(np.arange(len(n)), windows)
    at = first[:-1][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    covered = np.zeros(len(h) + 1, bool)
    if len(at):
        key = pair(pair(h[at], h[at + 1]), h[at + 2]) ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        k = key[order]
        same = np.concatenate([[False], k[1:] == k[:-1]])
        same[:-1] |= same[1:]
        twice = at[order[same]]
        for j in range(3):
            covered[twice + j] = True
    total = np.concatenate([[0], np.cumsum(covered[: len(h)])])
    return n, total[first[1:]] - total[first[:-1]]


def own_lines(raw: bytes) -> tuple[int, list[int], list[int]]:
    """(lines equal to an earlier one, hashes of the distinct normalised lines, the words each holds in all)."""
    seen, doubled, words = set(), 0, {}
    for line in raw.split(b"\n"):
        parts = line.split()  # bytes split at the six white-space bytes and at no other
        if not parts:
            continue
        if line in seen:
            doubled += 1
        seen.add(line)
        key = xxhash.xxh64_intdigest(b" ".join(parts).lower().translate(_DIGITS)) - (1 << 63)
        words[key] = words.get(key, 0) + len(parts)
    return doubled, list(words), list(words.values())


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measures(docs: DataFrame, id_col: str, text: str, host: str) -> DataFrame:
    """Own counts, content hash and lines (hash, words) of each row, with a row number that is
    unique once stored."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("_host", T.StringType()),
                           T.StructField("_row", T.LongType()), *[T.StructField(c, T.LongType()) for c in _COUNTS],
                           T.StructField("_content", T.LongType()), T.StructField("_lines", T.ArrayType(T.LongType())),
                           T.StructField("_words", T.ArrayType(T.LongType()))])

    def work(batches):
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            data, offs = utf8(b.column(0))
            raw = data.tobytes()
            counted = [repeat_words(data[offs[x]:offs[y]], offs[x:y + 1] - offs[x]) for x, y in chunks(offs)]
            n, again = (np.concatenate(c) for c in zip(*counted)) if counted else ([], [])
            texts = [raw[a:z] for a, z in zip(offs[:-1].tolist(), offs[1:].tolist())]
            lines = [own_lines(t) for t in texts]
            cols = [pa.array(n, pa.int64()),
                    pa.array([len(t.translate(None, _SPACES + _CONTINUED)) for t in texts], pa.int64()),
                    pa.array([len(t) - len(t.translate(None, _SYMBOLS)) for t in texts], pa.int64()),
                    pa.array([x[0] for x in lines], pa.int64()), pa.array(again, pa.int64()),
                    pa.array([xxhash.xxh64_intdigest(t) - (1 << 63) for t in texts], pa.int64()),
                    pa.array([x[1] for x in lines], pa.list_(pa.int64())),
                    pa.array([x[2] for x in lines], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [b.column(1), strings(b.column(2)).cast(pa.string()), pa.array(range(row, row + len(texts)), pa.int64()), *cols],
                schema.names)
            row += len(texts)

    return docs.select(F.col(text).alias("_text"), F.col(id_col), F.col(host).cast("string").alias("_host")
                       ).mapInArrow(work, schema)


def frequent_lines(rows: DataFrame, min_texts: int = MIN_TEXTS, share: float | None = None) -> DataFrame:
    """(_host, line) of lines in more distinct texts of the host than ``min_texts``, or than
    ``share`` of the host's distinct texts, but more than one, if that is less.

    Copies are dropped before lines are unfolded, and the counts are summed on
    the map side, so neither a large group of copies nor a line of every text
    crowds a task."""
    texts = rows.groupBy("_host", "_content").agg(F.first("_lines").alias("_lines"))
    counts = (texts.select("_host", F.explode("_lines").alias("line")).groupBy("_host", "line")
              .agg(F.count(F.lit(1)).alias("n")))
    if share is None:
        return counts.where(F.col("n") > min_texts).select("_host", "line")
    hosts = texts.groupBy("_host").agg(F.count(F.lit(1)).alias("texts"))
    limit = F.least(F.lit(float(min_texts)), F.greatest(F.lit(1.0), share * F.col("texts")))
    return counts.join(hosts, "_host").where(F.col("n") > limit).select("_host", "line")


def quality(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source",
            min_texts: int = MIN_TEXTS, share: float | None = None) -> DataFrame:
    """Own counts, base_failed, words in boilerplate lines and kept, for every row."""
    rows = stored(measures(docs, id_col, text, host), "lines")
    lines = rows.select("_row", "_host", F.explode(F.arrays_zip("_lines", "_words")).alias("l")).select(
        "_row", "_host", F.col("l._lines").alias("line"), F.col("l._words").alias("words"))
    removed = (lines.join(frequent_lines(rows, min_texts, share), ["_host", "line"])
               .groupBy("_row").agg(F.sum("words").alias("n_removed_words")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words")
    return (rows.drop("_lines", "_words").join(removed, "_row", "left")
            .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)))
            .select(F.col(id_col), *_COUNTS, failed.alias("base_failed"), "n_removed_words",
                    (~failed & (left >= MIN_WORDS) & (left >= MIN_LEFT * F.col("n_words"))).alias("kept")))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"))


QUERIES = {"op7_quality_rules": op7_quality_rules}
