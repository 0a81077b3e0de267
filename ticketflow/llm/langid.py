"""Language identification by a byte convolutional network.

Filters of several widths slide over fixed-length windows of a text's
(lower-cased) bytes, the strongest answer of each filter in a window goes
through a softmax layer, and a text's probabilities are the mean over all its
windows, weighted by the bytes they hold.  Consecutive windows overlap by the
widest filter less one, so every place of the whole text is seen.

The network is trained in numpy on a bounded sample of labelled rows: for each
language the ``per_lang`` texts with the smallest id hashes, ``windows`` windows
evenly spread over each.

Defined results: a text that is null or has no letter is ``und`` with score 0;
rows without a language are never learnt from; with nothing to learn from every
text is ``und``; repeated rows are predicted each; an empty table gives no rows;
columns that are not named are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, held_out, read, stored, utf8
from .tokens import LOWER

LENGTH = 64
WIDTHS = (2, 3, 4)
STEP = LENGTH - max(WIDTHS) + 1
UNDETERMINED = "und"


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, bytes held, text of each window): all windows of all texts, zeros after a text's end."""
    size = np.diff(offsets)
    n = np.maximum(1, -(-(size - (LENGTH - STEP)) // STEP))
    owner = np.repeat(np.arange(len(size)), n)
    begin = offsets[:-1][owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * STEP
    held = np.minimum(offsets[1:][owner] - begin, LENGTH)
    padded = np.concatenate([LOWER[data], np.zeros(LENGTH, np.uint8)])
    x = np.lib.stride_tricks.sliding_window_view(padded, LENGTH)[begin].copy()
    short = np.flatnonzero(held < LENGTH)
    x[short] *= np.arange(LENGTH) < held[short, None]
    return x, held, owner


class Network:
    """Byte filters, max pooling, softmax.  ``filters[w]`` has a weight for each place, byte and filter."""

    def __init__(self, n_out: int, per_width: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.filters = {w: (rng.standard_normal((w, 256, per_width)) * 0.3).astype(np.float32) for w in WIDTHS}
        self.bias = np.zeros(per_width * len(WIDTHS), np.float32)
        self.out = (rng.standard_normal((per_width * len(WIDTHS), n_out)) * 0.1).astype(np.float32)
        self.out_bias = np.zeros(n_out, np.float32)

    def pooled(self, x: np.ndarray, places: bool = False):
        """(windows, filters) strongest answers, and where they are."""
        top, where = [], []
        for w, f in self.filters.items():
            n = x.shape[1] - w + 1
            a = f[0][x[:, :n]]
            for j in range(1, w):
                a += f[j][x[:, j:j + n]]
            if places:
                at = a.argmax(axis=1)
                where.append(at)
                top.append(np.take_along_axis(a, at[:, None], 1)[:, 0])
            else:
                top.append(a.max(axis=1))
        return np.concatenate(top, axis=1) + self.bias, where

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def probabilities(self, x: np.ndarray, block: int = 1024) -> np.ndarray:
        out = np.empty((len(x), self.out.shape[1]), np.float32)
        for i in range(0, len(x), block):
            top, _ = self.pooled(x[i:i + block])
            out[i:i + block] = self._softmax(np.maximum(top, 0) @ self.out + self.out_bias)
        return out

    def _parameters(self):
        return [*self.filters.values(), self.bias, self.out, self.out_bias]

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        top, where = self.pooled(x, places=True)
        hidden = np.maximum(top, 0)
        d = self._softmax(hidden @ self.out + self.out_bias)
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        back = (d @ self.out.T) * (top > 0)
        grads, first = [], 0
        rows = np.arange(len(x))[:, None]
        for (w, f), at in zip(self.filters.items(), where):
            k = f.shape[2]
            part = back[:, first:first + k]
            g = np.empty_like(f)
            for j in range(w):
                cell = x[rows, at + j].astype(np.int64) * k + np.arange(k)
                g[j] = np.bincount(cell.ravel(), part.ravel(), 256 * k).reshape(256, k)
            grads.append(g)
            first += k
        return [*grads, back.sum(0), hidden.T @ d, d.sum(0)]

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, batch: int = 256, rate: float = 0.01, seed: int = 11):
        """Adam; every language weighs the same."""
        rng = np.random.default_rng(seed)
        n_out = self.out.shape[1]
        size = max(np.bincount(y, minlength=n_out).max(), 1)
        rows = np.concatenate([rng.choice(r, size, replace=len(r) < size) for c in range(n_out)
                               if len(r := np.flatnonzero(y == c))])
        m = [np.zeros_like(p) for p in self._parameters()]
        v = [np.zeros_like(p) for p in self._parameters()]
        t = 0
        for epoch in range(epochs):
            rng.shuffle(rows)
            step = rate * (1 - epoch / epochs)
            for i in range(0, len(rows), batch):
                xb, yb = x[rows[i:i + batch]].copy(), y[rows[i:i + batch]]
                # short texts are a window with few bytes: a third of the rows are cut to a chance length
                keep = np.where(rng.random(len(xb)) < 0.33, rng.integers(4, LENGTH, len(xb)), LENGTH)
                xb *= np.arange(LENGTH) < keep[:, None]
                t += 1
                for p, g, a, b in zip(self._parameters(), self._gradients(xb, yb), m, v):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    p -= step * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)
        return self


def _windows(per_text: int):
    """Up to ``per_text`` windows of each text, evenly spread."""
    def work(batches):
        for b in batches:
            data, offs = utf8(b.column(0))
            for x, y in chunks(offs):
                w, held, owner = cut(data[offs[x]:offs[y]], offs[x:y + 1] - offs[x])
                n = np.bincount(owner, minlength=y - x)
                place = np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
                keep = np.flatnonzero((place * per_text // n[owner]) != ((place - 1) * per_text // n[owner]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(1).take(pa.array(x + owner[keep])),
                     pa.array([r.tobytes() for r in w[keep]], pa.binary())], ["lang", "bytes"])
    return work


def train(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", per_lang: int = 400,
          windows: int = 12) -> tuple[list[str], Network]:
    """Languages and the network learnt from the rows of ``docs`` with a text and a language.

    A first pass counts each language's rows, which gives the share of the hash
    range that holds about ``per_lang`` of them (all, where there are fewer); then
    only those rows' windows come to the driver (about ``per_lang`` x ``windows`` x
    64 bytes a language).
    """
    ranked = F.xxhash64(F.col(id_col), F.lit(5))
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    sizes = rows.groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()
    edge = sorted((r.lang, min((1 << 64) * per_lang // r.n, (1 << 64) - 1) - (1 << 63)) for r in sizes)
    if not edge:
        return [], Network(1)
    table = F.create_map(*[F.lit(v) for kv in edge for v in kv])
    chosen = (rows.where(ranked <= F.element_at(table, F.col(lang)))
              .groupBy(F.col(id_col).alias("i"), F.col(lang).alias("lang")).agg(F.min(text).alias("text"))
              .select("text", "lang", "i"))
    got = chosen.mapInArrow(_windows(windows), "lang string, bytes binary").toArrow()
    got = got.sort_by([("lang", "ascending"), ("bytes", "ascending")])  # the order rows come in has no effect
    langs = [x for x, _ in edge]
    x = np.frombuffer(b"".join(got.column("bytes").to_pylist()), np.uint8).reshape(-1, LENGTH)
    place = {c: i for i, c in enumerate(langs)}
    y = np.array([place[c] for c in got.column("lang").to_pylist()], np.int64)
    return langs, Network(len(langs)).fit(x, y)


def predict(docs: DataFrame, langs: list[str], net: Network, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and lang_pred, score (mean probability of that language) of every row."""
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    names = np.array([*langs, UNDETERMINED], object)

    def work(batches):
        for b in batches:
            data, offs = utf8(b.column(0))
            letters = np.array(b.column(1).to_pylist(), bool)
            best, score = np.full(len(letters), len(langs)), np.zeros(len(letters))
            for x, y in chunks(offs):
                own = np.flatnonzero(letters[x:y])
                if not len(own) or not langs:
                    continue
                w, held, owner = cut(data[offs[x]:offs[y]], offs[x:y + 1] - offs[x])
                p = net.probabilities(w) * held[:, None]
                p = np.add.reduceat(p, np.searchsorted(owner, np.arange(y - x)), axis=0, dtype=np.float64)
                p = p[own] / p[own].sum(axis=1, keepdims=True)
                best[x + own] = p.argmax(axis=1)
                score[x + own] = p.max(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns[2:], pa.array(names[best], pa.string()), pa.array(score)],
                                             schema.names)

    src = docs.select(F.col(text).alias("_text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letter"),
                      *[F.col(c) for c in keep])
    return src.mapInArrow(work, schema)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", held_out("doc_id", 4))
    langs, net = train(docs.where(~F.col("held_out")))
    return predict(docs, langs, net, ["doc_id", "held_out"])


#: A language's limit is this quantile of the scores of held-out texts that are predicted right: its own
#: texts, each of weight one, and those of all languages, of this many texts' weight together.
QUANTILE = 0.005
PRIOR = 200


def limits(scored: DataFrame, langs: list[str], quantile: float = QUANTILE, prior: float = PRIOR) -> dict[str, float]:
    """The score limit of every language of ``langs``, from the right predictions in ``scored`` (``lang``,
    ``lang_pred``, ``score``).

    The same rule holds at every size: a language with many calibration texts is
    judged by them, one with few mostly by the pooled texts.  The text to be judged counts as one more with
    score 0 on both sides, so the quantile of too few texts is 0 and clean texts stay.  Scores are
    counted in steps of 1/1000, so one row for each language and step comes to the driver.
    """
    bins: dict[str, dict[int, int]] = {c: {} for c in langs}
    for r in (scored.where(F.col("lang") == F.col("lang_pred")).groupBy("lang", F.floor(F.col("score") * 1000).alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")).collect()):
        bins.setdefault(r.lang, {})[r.bin] = r.n
    pooled: dict[int, int] = {}
    for held in bins.values():
        for b, n in held.items():
            pooled[b] = pooled.get(b, 0) + n
    each = prior / (sum(pooled.values()) + 1)
    out = {}
    for lang, held in bins.items():
        below, out[lang] = 1 + each, 0.0
        goal = quantile * (sum(held.values()) + 1 + prior)
        for b in sorted(pooled):
            if below > goal:
                break
            below += held.get(b, 0) + each * pooled[b]
            out[lang] = b / 1000
    return out


def stage(docs: DataFrame, quantile: float = QUANTILE, prior: float = PRIOR) -> DataFrame:
    """The rows of ``docs`` whose language the network can tell: texts without a letter go, and
    those with a score below the limit of their predicted language, which held-out labelled
    texts give whatever the number of languages (with very few such texts, no score is too low).
    A missing ``lang`` is filled with the prediction.  Rows are scored once and kept in the shared
    folder, where the limits and the result read them."""
    private = {c: f"_in{i}" for i, c in enumerate(docs.columns)}  # free of the names used inside
    inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in private.items()])
    text, lang, id_col = (private[c] for c in ("text", "lang", "doc_id"))
    langs, net = train(inner.where(~held_out(id_col, 4)), text, lang, id_col)
    out = stored(predict(inner, langs, net, list(private.values()), text), "langid-scored")
    known = out.where(held_out(id_col, 4)).select(F.col(lang).alias("lang"), "lang_pred", "score")
    edge = F.lit(0.0)
    for name, least_score in sorted(limits(known, langs, quantile, prior).items()):
        edge = F.when(F.col("lang_pred") == name, least_score).otherwise(edge)
    ok = out.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= edge))
    return ok.select(*[(F.coalesce(n, "lang_pred") if n == lang else F.col(n)).alias(c) for c, n in private.items()])


QUERIES = {"op5_language_id": op5_language_id}
