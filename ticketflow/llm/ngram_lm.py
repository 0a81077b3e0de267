"""Language-model scores: an interpolated modified Kneser-Ney bigram model.

Counting is a Spark job: every task sums its own pairs, the pairs are dealt by
a hash of the pair (so that no frequent word makes a crowded shard), each shard
sums them and stores a sorted array of pair hashes with counts in the shared
folder; what a pair adds to its two words is dealt by word and summed the same
way.  Scoring maps the sorted arrays into the workers' memory and looks up the
pairs of each batch in order, so it has no shuffle and holds no model on the heap.

Files are written under a task's own name and renamed, so a retried or
duplicated task leaves one whole file.

Defined results: a null or empty text is the end mark alone; without any
training text every probability is that of the uniform distribution over the
one unknown word; repeated rows are counted and scored each; an empty table
gives no rows; columns that are not named are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, held_out, map_file, put_file, read, shared_folder, stored, utf8
from .kn import BEGIN, discounted, discounts, pack, pack_sorted, steps, sums, unpack, unpack_sorted
from .tokens import pair

#: Pairs a task holds before it sums and sends them on.
HELD = 4_000_000

_PAIRS = "shard int, n int, lefts binary, rights binary, counts binary"
_WORDS = ("shard int, n int, word binary, kinds binary, seen binary, total binary, once binary, twice binary, "
          "more binary, n1 long, n2 long, n3 long, n4 long")
_FIELDS = ("kinds", "seen", "total", "once", "twice", "more")


def _shard(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def _cuts(sorted_keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each of the 2^bits shards begins in sorted keys."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(sorted_keys, edges), [len(sorted_keys)]])


def _counted(bits: int):
    def send(left, right, count):
        key = pair(left, right)
        order = np.argsort(key, kind="stable")
        cuts = _cuts(key[order], bits)
        for shard in np.flatnonzero(np.diff(cuts)):
            rows = order[cuts[shard]:cuts[shard + 1]]
            rows = rows[np.argsort(left[rows], kind="stable")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([len(rows)], pa.int32()),
                 pa.array([pack_sorted(left[rows])], pa.binary()), pa.array([pack(right[rows])], pa.binary()),
                 pa.array([pack(count[rows])], pa.binary())], ["shard", "n", "lefts", "rights", "counts"])

    def summed(held):
        left, right, count = (np.concatenate(x) for x in zip(*held))
        key = pair(left, right)
        order = np.argsort(key, kind="stable")
        k = key[order]
        cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
        total = np.add.reduceat(count[order], cut) if len(k) else count
        return left[order[cut]], right[order[cut]], total

    def work(batches):
        held, n = [], 0
        for b in batches:
            data, offs = utf8(b.column(0))
            for x, y in chunks(offs):
                left, right, _ = steps(data[offs[x]:offs[y]], offs[x:y + 1] - offs[x])
                held.append((left, right, np.ones(len(left), np.int64)))
                n += len(left)
                if n >= HELD:
                    held = [summed(held)]
                    n = len(held[0][0])
                    if n >= HELD // 2:
                        yield from send(*held[0])
                        held, n = [], 0
        if held:
            yield from send(*summed(held))

    return work


def _store_pairs(folder: str, bits: int):
    """One shard: sum its pairs, store them, and send what they add to their words."""
    def work(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        ns = table.column("n").to_pylist()
        left = np.concatenate([unpack_sorted(b, n) for b, n in zip(table.column("lefts").to_pylist(), ns)])
        right = np.concatenate([unpack(b, n) for b, n in zip(table.column("rights").to_pylist(), ns)])
        count = np.concatenate([unpack(b, n) for b, n in zip(table.column("counts").to_pylist(), ns)]).astype(np.int64)
        key = pair(left, right)
        order = np.argsort(key, kind="stable")
        k = key[order]
        cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        total = np.add.reduceat(count[order], cut)
        put_file(folder, f"pair-{shard}.key", [k[cut].astype("<u8")])
        put_file(folder, f"pair-{shard}.count", [total.astype("<u8")])
        left, right = left[order[cut]], right[order[cut]]
        nil = np.zeros(len(left), np.int64)
        one = np.ones(len(left), np.int64)
        words = sums(np.concatenate([right, left]),
                     np.concatenate([one, nil]),                             # kinds: pairs that end in the word
                     np.concatenate([total, nil]),                           # seen: how often it was predicted
                     np.concatenate([nil, total]),                           # total: how often it led
                     np.concatenate([nil, (total == 1).astype(np.int64)]),
                     np.concatenate([nil, (total == 2).astype(np.int64)]),
                     np.concatenate([nil, (total > 2).astype(np.int64)]))
        cuts = _cuts(words[0], bits)
        rows = {f.split()[0]: [] for f in _WORDS.split(", ")}
        counts_of = [int((total == i).sum()) for i in (1, 2, 3, 4)]
        for part in np.flatnonzero(np.diff(cuts)):
            a, b = cuts[part], cuts[part + 1]
            rows["shard"].append(int(part))
            rows["n"].append(int(b - a))
            rows["word"].append(pack_sorted(words[0][a:b]))
            for f, v in zip(_FIELDS, words[1:]):
                rows[f].append(pack(v[a:b]))
            for f, v in zip(("n1", "n2", "n3", "n4"), counts_of):
                rows[f].append(v)
            counts_of = [0, 0, 0, 0]
        types = [pa.int32(), pa.int32(), *[pa.binary()] * 7, *[pa.int64()] * 4]
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(rows.items(), types)})

    return work


def _store_words(folder: str, d: tuple[float, float, float]):
    """One shard of words: sum, store (hash; seen, kinds, total, backoff weight) and report its totals."""
    def work(table: pa.Table) -> pa.Table:
        ns = table.column("n").to_pylist()
        word = np.concatenate([unpack_sorted(b, n) for b, n in zip(table.column("word").to_pylist(), ns)])
        fields = [np.concatenate([unpack(b, n) for b, n in zip(table.column(f).to_pylist(), ns)]).astype(np.int64)
                  for f in _FIELDS]
        word, kinds, seen, total, once, twice, more = sums(word, *fields)
        weight = (d[0] * once + d[1] * twice + d[2] * more) / np.maximum(total, 1)
        shard = table.column("shard")[0].as_py()
        put_file(folder, f"word-{shard}.key", [word.astype("<u8")])
        put_file(folder, f"word-{shard}.row",
                 [np.stack([seen, kinds, total, np.where(total > 0, weight, 1.0)], axis=1).astype("<f8")])
        got = [int((seen > 0).sum()), int(seen.sum()), int(kinds.sum()), *[int((kinds == i).sum()) for i in (1, 2, 3, 4)],
               int((kinds > 2).sum())]
        return pa.table({c: pa.array([v], pa.int64()) for c, v in zip(_TOTALS, got)})

    return work


_TOTALS = ("vocabulary", "tokens", "pairs", "n1", "n2", "n3", "n4", "more")


class Model:
    """Where the sorted arrays lie and the few numbers that belong to the whole model."""

    def __init__(self, folder: str, bits: int, d2, d1, totals: dict):
        self.folder, self.bits, self.d2, self.d1 = folder, bits, d2, d1
        self.tokens, self.vocabulary, self.pairs = totals["tokens"], totals["vocabulary"], totals["pairs"]
        left_over = d1[0] * totals["n1"] + d1[1] * totals["n2"] + d1[2] * totals["more"]
        #: the share of the uniform distribution over the vocabulary and one unknown word
        self.uniform = (left_over / self.pairs if self.pairs else 1.0) / (self.vocabulary + 1)
        self._maps: dict = {}

    def __getstate__(self):
        return self.__dict__ | {"_maps": {}}

    def _map(self, name: str, kind: str) -> np.ndarray:
        if name not in self._maps:
            self._maps[name] = map_file(self.folder, name).view(kind)
        return self._maps[name]

    def _find(self, what: str, keys: np.ndarray, values: str, width: int) -> np.ndarray:
        """Stored values of sorted distinct keys, zeros where there are none."""
        out = np.zeros((len(keys), width), np.float64)
        cuts = _cuts(keys, self.bits)
        for shard in np.flatnonzero(np.diff(cuts)):
            a, b = cuts[shard], cuts[shard + 1]
            stored_keys = self._map(f"{what}-{shard}.key", "<u8")
            if not len(stored_keys):
                continue
            at = np.minimum(np.searchsorted(stored_keys, keys[a:b]), len(stored_keys) - 1)
            hit = np.flatnonzero(stored_keys[at] == keys[a:b])
            rows = self._map(f"{what}-{shard}.{values}", "<u8" if values == "count" else "<f8").reshape(-1, width)
            out[a + hit] = rows[at[hit]]
        return out

    def score(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(training count of each right word, log10 probability of each right word after its left word)."""
        words, at = np.unique(np.concatenate([right, left]), return_inverse=True)
        seen, kinds, total, weight = self._find("word", words, "row", 4).T
        kinds = kinds.astype(np.int64)
        low = discounted(kinds, self.d1) / max(self.pairs, 1) + self.uniform
        r, le = at[: len(right)], at[len(right):]
        keys, where = np.unique(pair(left, right), return_inverse=True)
        count = self._find("pair", keys, "count", 1)[:, 0][where].astype(np.int64)
        lead = total[le]
        p = np.where(lead > 0, discounted(count, self.d2) / np.maximum(lead, 1) + weight[le] * low[r], low[r])
        return seen[r], np.log10(p)


def train(texts: DataFrame, text: str = "text", shards: int | None = None) -> Model:
    """Count the ``text`` column of all rows into a model in the shared folder.

    ``shards`` (rounded up to a power of two) sets how many sorted arrays there
    are; by default as many as the session's shuffle partitions, which a job
    sizes by its input anyway.
    """
    spark = texts.sparkSession
    bits = max(int(shards or spark.conf.get("spark.sql.shuffle.partitions")) - 1, 0).bit_length()
    folder = shared_folder(spark, "lm")
    pairs = texts.select(F.col(text)).mapInArrow(_counted(bits), _PAIRS)
    words = stored(pairs.groupBy("shard").applyInArrow(_store_pairs(folder, bits), _WORDS), "lm-words")
    n = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n1", "n2", "n3", "n4")]).first()
    d2 = discounts(*n)
    totals = stored(words.groupBy("shard").applyInArrow(
        _store_words(folder, d2), ", ".join(f"{c} long" for c in _TOTALS)), "lm-totals")
    t = totals.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _TOTALS]).first().asDict()
    return Model(folder, bits, d2, discounts(t["n1"], t["n2"], t["n3"], t["n4"]), t)


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and n_tokens, n_known, base_score, score of every row."""
    schema = T.StructType([*[docs.schema[c] for c in keep],
                           *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")],
                           *[T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]])

    def work(batches):
        for b in batches:
            data, offs = utf8(b.column(0))
            got = []
            for x, y in chunks(offs):
                left, right, first = steps(data[offs[x]:offs[y]], offs[x:y + 1] - offs[x])
                seen, logp = model.score(left, right)
                base = np.log10((seen + 1) / (model.tokens + model.vocabulary + 1))
                got.append((np.diff(first), np.add.reduceat((seen > 0).astype(np.int64), first[:-1]),
                            np.add.reduceat(base, first[:-1]), np.add.reduceat(logp, first[:-1])))
            cols = [np.concatenate(v) for v in zip(*got)] if got else [np.zeros(0)] * 4
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], *[pa.array(v, pa.int64()) for v in cols[:2]],
                 *[pa.array(v, pa.float64()) for v in cols[2:]]], schema.names)

    return docs.select(F.col(text).alias("_text"), *[F.col(c) for c in keep]).mapInArrow(work, schema)


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", held_out("doc_id", 7).alias("held_out"))
    model = train(docs.where(~F.col("held_out")))
    return score(docs, model, ["doc_id", "held_out"]).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score")


QUERIES = {"op6_lm_scores": op6_lm_scores}
