"""Repeated passages: words in a stretch of ``window`` words that also begins earlier are removed.

An index of a whole corpus fits no machine, so equal stretches are first brought
to one shard, and each shard is indexed by itself:

1. Sampled places.  Of the word 8-grams of a window the smallest hash is its
   anchor, so equal windows have equal anchors.  Every task sends its distinct
   anchors with counts, Spark sums them, and those seen twice or more are
   written as sorted arrays that the workers map into memory.
2. All places of what is left.  The 8-grams of windows with a repeated anchor are
   counted the same way.  A window that leans out of a frequent passage holds an
   8-gram seen once and goes here, so no passage, however frequent, brings the
   words around it to its shard.
3. Shards.  Windows with the same anchor that follow each other are one segment; a task
   sends each of its distinct segments once, with its first place.  A shard (by
   anchor; as many as the counted 8-grams ask for) builds a compressed
   FM-index (`fm_index`) of its segments and streams them through it: backward
   search gives their matching statistics, and each window that reaches the threshold
   the group of index rows of its words, whose first place is the earliest one.
4. Every text is read again, its segments found in the shards' reports, and
   words of windows whose earliest place is before their own are removed.

Words and segments are told apart by 64-bit hashes (segments within their shard).
Nothing is shuffled but distinct anchors, 8-grams and segments of each task: a group
of copies, or a line in a third of the texts, sends one row a task.  Files are
written under a task's own name and renamed, so tasks may run twice.

Defined results: a null or empty text has no words; a null id comes before all
others; rows with one id are one document, so equal stretches at equal places of
them stay; texts shorter than the window stay; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, map_file, put_file, read, shared_folder, stored, utf8
from .fm_index import FMIndex
from .tokens import hashes, mix, spans

WINDOW = 20
GRAM = 8
#: Distinct hashes or segments a task holds before it sends them on.
HELD = 1_000_000
HELD_SEGMENTS = 80_000
#: Hashes in one sorted array, and repeated 8-grams (about as many windows) in one shard.
ARRAY, SHARD = 1 << 19, 100_000
#: Files that a worker keeps mapped (4 MB or less each).
MAPPED = 12

_P = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 28) - 1)  # words of one text at most
_FIRST = np.int64(-2**63)


def _least(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    done = 1
    while done * 2 <= width:
        v = np.minimum(v[:-done], v[done:])
        done *= 2
    return np.minimum(v[:len(v) - (width - done)], v[width - done:]) if done < width else v


class Texts:
    """Words, 8-grams and windows of some texts.

    ``starts`` are the first words of all windows within one text, ``anchors``
    the places of their anchors (never decreasing).
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
        self.window, self.gram = window, gram
        begin, end, self.first = spans(data, offsets)
        self.codes = hashes(data, begin, end, lower=False)
        n = len(self.codes)
        self.starts = self.anchors = np.zeros(0, np.int64)
        self.grams = np.zeros(0, np.uint64)
        if n < window:
            return
        g = self.codes[:n - gram + 1].copy()
        for j in range(1, gram):
            g *= _P
            g += self.codes[j:n - gram + 1 + j]
        self.grams = mix(g)
        order = (self.grams & ~_PLACE) | np.arange(len(g), dtype=np.uint64)
        least = _least(order, window - gram + 1)
        last = np.repeat(self.first[1:], np.diff(self.first))
        self.starts = np.flatnonzero(np.arange(len(least)) + window <= last[:len(least)])
        self.anchors = (least[self.starts] & _PLACE).astype(np.int64)

    def keep(self, windows: np.ndarray) -> None:
        self.starts, self.anchors = self.starts[windows], self.anchors[windows]

    def distinct_anchors(self) -> np.ndarray:
        """Places of anchors, each once."""
        a = self.anchors
        return a[np.concatenate([[True], a[1:] != a[:-1]])] if len(a) else a

    def with_anchor_in(self, known: KeySet) -> None:
        at = self.distinct_anchors()
        good = known.holds(self.grams[at])
        self.keep(good[np.searchsorted(at, self.anchors)] if len(at) else np.zeros(0, bool))

    def covered_grams(self) -> np.ndarray:
        """Places of all 8-grams of the windows."""
        step = np.zeros(len(self.grams) + 1, np.int64)
        step[self.starts] += 1
        step[self.starts + self.window - self.gram + 1] -= 1
        return np.flatnonzero(np.cumsum(step)[:-1])

    def with_all_grams_in(self, known: KeySet) -> None:
        at = self.covered_grams()
        lost = np.zeros(len(self.grams) + 1, np.int64)
        lost[1:][at[~known.holds(self.grams[at])]] = 1
        lost = np.cumsum(lost)
        self.keep(lost[self.starts + self.window - self.gram + 1] == lost[self.starts])

    def segments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, number of windows, hash) of runs of windows with one anchor."""
        s, a = self.starts, self.anchors
        if not len(s):
            return s, s, np.zeros(0, np.uint64)
        cut = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (s[1:] != s[:-1] + 1)]))
        start, count = s[cut], np.diff(np.append(cut, len(s)))
        return start, count, _stretch_hash(self.codes, start, start + count + self.window - 1)

    def owners(self, words: np.ndarray) -> np.ndarray:
        """The text of each word place."""
        return np.searchsorted(self.first, words, "right") - 1


def _stretch_hash(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    power = np.full(len(codes) + 1, _P, np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    total = np.concatenate([[np.uint64(0)], np.cumsum(codes * power[:-1], dtype=np.uint64)])
    # equal stretches at different places differ by a power of _P: bring all to the highest place
    return mix((total[end] - total[start]) * power[len(codes) - start] + (end - start).astype(np.uint64))


class Mapped:
    """Files of a shared folder, the last few of them mapped into memory."""

    def __init__(self, folder: str):
        self.folder, self._maps = folder, {}

    def __getstate__(self):
        return self.__dict__ | {"_maps": {}}

    def file(self, name: str) -> np.ndarray:
        if name not in self._maps:
            while len(self._maps) >= MAPPED:
                del self._maps[next(iter(self._maps))]
            self._maps[name] = map_file(self.folder, name)
        return self._maps[name]


class KeySet(Mapped):
    """A set of 64-bit hashes as sorted arrays in the shared folder, one a range of the highest bits."""

    def __init__(self, folder: str, bits: int, size: int):
        super().__init__(folder)
        self.bits, self.size = bits, size

    @classmethod
    def written(cls, keys: DataFrame) -> KeySet:
        """From distinct rows of one long column."""
        spark, name = keys.sparkSession, keys.columns[0]
        size = keys.count()
        bits = max(-(-size // ARRAY) - 1, 0).bit_length()
        folder = shared_folder(spark, "keys")
        top = F.shiftrightunsigned(F.col(name), 64 - bits) if bits else F.lit(0).cast("long")

        def write(table: pa.Table) -> pa.Table:
            part = table.column(0)[0].as_py()
            own = np.sort(table.column(1).to_numpy().view(np.uint64))
            put_file(folder, f"{part}.key", [own.astype("<u8")])
            return pa.table({"n": pa.array([len(own)], pa.int64())})

        keys.select(top.alias("part"), name).groupBy("part").applyInArrow(write, "n long").agg(F.sum("n")).first()
        return cls(folder, bits, size)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), bool)
        if not self.size or not len(keys):
            return out
        sought, back = np.unique(keys, return_inverse=True)
        hit = np.zeros(len(sought), bool)
        edges = np.arange(1, 1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits) if self.bits else []
        cuts = np.concatenate([[0], np.searchsorted(sought, edges), [len(sought)]]).astype(np.int64)
        for part in np.flatnonzero(np.diff(cuts)):
            stored_keys, own = self.file(f"{part}.key").view("<u8"), sought[cuts[part]:cuts[part + 1]]
            if len(stored_keys):
                at = np.minimum(np.searchsorted(stored_keys, own), len(stored_keys) - 1)
                hit[cuts[part]:cuts[part + 1]] = stored_keys[at] == own
        return hit[back.reshape(-1)]


def _each(batches, window: int, gram: int, text: int = 0):
    """(batch, rows x to y, their Texts) in rounds of bounded size."""
    for b in batches:
        data, offs = utf8(b.column(text))
        for x, y in chunks(offs):
            yield b, x, y, Texts(data[offs[x]:offs[y]], offs[x:y + 1] - offs[x], window, gram)


def _counting(window: int, gram: int, select):
    """Tasks that send each distinct hash chosen by ``select(texts)`` once, with its count (2 for more)."""
    def work(batches):
        held, n = [], 0

        def summed():
            keys, count = (np.concatenate(v) for v in zip(*held))
            order = np.argsort(keys, kind="stable")
            k = keys[order]
            cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            return k[cut], np.minimum(np.add.reduceat(count[order], cut), 2)

        def send(keys, count):
            for i in range(0, len(keys), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i:i + (1 << 17)].view(np.int64)),
                                                  pa.array(count[i:i + (1 << 17)].astype(np.int8))], ["h", "n"])
        for _, _, _, texts in _each(batches, window, gram):
            keys = select(texts)
            if len(keys):
                held.append((keys, np.ones(len(keys), np.int64)))
                n += len(keys)
            if n >= HELD:
                held = [summed()]
                n = len(held[0][0])
                if n >= HELD // 2:
                    yield from send(*held[0])
                    held, n = [], 0
        if held:
            yield from send(*summed())

    return work


def _repeated(texts: DataFrame, window: int, gram: int, select) -> KeySet:
    sent = texts.mapInArrow(_counting(window, gram, select), "h long, n byte")
    return KeySet.written(stored(sent.groupBy("h").agg(F.sum("n").alias("n")).where("n >= 2").select("h"), "repeated"))


def _chosen(texts: Texts, anchors: KeySet, grams: KeySet) -> None:
    texts.with_anchor_in(anchors)
    texts.with_all_grams_in(grams)


def _shard_of(hashed: np.ndarray, shards: int) -> np.ndarray:
    return ((hashed >> np.uint64(16)) % np.uint64(shards)).astype(np.int32)


def _slices(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values of all slices one after the other, offsets)."""
    offs = np.concatenate([[0], np.cumsum(size)])
    return values[np.repeat(start - offs[:-1], size) + np.arange(offs[-1])], offs


def _ids(column) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(int(_FIRST)).to_numpy(zero_copy_only=False)


def _segments(window: int, gram: int, anchors: KeySet, grams: KeySet, shards: int):
    """Tasks that send each of their distinct segments once, with its first place."""
    names = ["shard", "key", "doc", "start", "codes"]

    def work(batches):
        held, n = [], 0

        def summed():
            shard, key, doc, start, size = (np.concatenate([h[i] for h in held]) for i in range(5))
            codes = np.concatenate([h[5] for h in held])
            order = np.lexsort((start, doc, key, shard))
            new = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | (shard[order][1:] != shard[order][:-1])])
            own = order[new]
            codes, _ = _slices(codes, (np.cumsum(size) - size)[own], size[own])
            return shard[own], key[own], doc[own], start[own], size[own], codes

        def send(shard, key, doc, start, size, codes):
            offs = np.concatenate([[0], np.cumsum(size)])
            for i in range(0, len(key), 20_000):
                j = min(i + 20_000, len(key))
                blob = pa.BinaryArray.from_buffers(
                    pa.binary(), j - i, [None, pa.py_buffer(((offs[i:j + 1] - offs[i]) * 8).astype(np.int32)),
                                         pa.py_buffer(codes[offs[i]:offs[j]].astype("<u8"))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard[i:j]), pa.array(key[i:j].view(np.int64)), pa.array(doc[i:j]),
                     pa.array(start[i:j].astype(np.int32)), blob], names)
        for b, x, y, t in _each(batches, window, gram):
            _chosen(t, anchors, grams)
            at, count, key = t.segments()
            if not len(at):
                continue
            row = t.owners(at)
            # the anchor lies in every window of its segment
            shard = _shard_of(t.grams[t.anchors[np.searchsorted(t.starts, at)]], shards)
            size = count + window - 1
            codes, _ = _slices(t.codes, at, size)
            held.append((shard, key, _ids(b.column(1).slice(x, y - x))[row], at - t.first[row], size, codes))
            n += len(at)
            if n >= HELD_SEGMENTS:
                held = [summed()]
                n = len(held[0][0])
                if n >= HELD_SEGMENTS // 2:
                    yield from send(*held[0])
                    held, n = [], 0
        if held:
            yield from send(*summed())

    return work


def earliest(codes: np.ndarray, first: np.ndarray, doc: np.ndarray, start: np.ndarray, window: int):
    """(first document, first word, matching statistic) of every place of the sequences, by an FM-index of them;
    places at which no whole window begins have document and word -1."""
    size = np.diff(first)
    index = FMIndex(codes, first, window, int(size.max(initial=0)))
    word = start[np.repeat(np.arange(len(size)), size)] + np.arange(len(codes)) - np.repeat(first[:-1], size)
    owner = np.repeat(doc, size)
    order = np.lexsort((word, owner))
    rank = np.full(len(index.order), len(codes), np.int64)       # separators come last
    rank[index.place[order]] = np.arange(len(codes))
    cut = np.flatnonzero(np.concatenate([[True], index.group[1:] != index.group[:-1]]))
    least = np.minimum.reduceat(rank[index.order], cut) if len(cut) else rank
    length, row = index.statistics(codes, first)
    found = length >= window
    at = order[least[index.group[row[found]]]]
    out_doc, out_word = np.full(len(codes), -1, np.int64), np.full(len(codes), -1, np.int64)
    out_doc[found], out_word[found] = owner[at], word[at]
    return out_doc, out_word, length


def _index(folder: str, window: int):
    """One shard: index its segments, search them, and write for each the earliest place of its windows."""
    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        key = table.column("key").to_numpy().view(np.uint64)
        doc, start = table.column("doc").to_numpy(), table.column("start").to_numpy().astype(np.int64)
        blob = table.column("codes").combine_chunks()
        if isinstance(blob, pa.ChunkedArray):
            blob = pa.concat_arrays(blob.chunks)
        blob = blob.cast(pa.large_binary())
        offs = np.frombuffer(blob.buffers()[1], np.int64, len(blob) + 1, blob.offset * 8)
        flat = np.frombuffer(blob.buffers()[2], "<u8", (offs[-1] - offs[0]) // 8, offs[0])
        offs = (offs - offs[0]) // 8
        order = np.lexsort((start, doc, key))
        own = order[np.concatenate([[True], key[order][1:] != key[order][:-1]])]  # tasks may send the same segment
        size = np.diff(offs)[own]
        codes, first = _slices(flat, offs[own], size)
        found_doc, found_word, _ = earliest(codes, first, doc[own], start[own], window)
        count = size - window + 1
        where, _ = _slices(np.arange(len(codes)), first[:-1], count)
        shard = table.column("shard")[0].as_py()
        put_file(folder, f"{shard}.report", [
            np.array([len(own)], "<i8"), key[own].astype("<u8"), np.concatenate([[0], np.cumsum(count)]).astype("<i8"),
            found_doc[where].astype("<i8"), found_word[where].astype("<i4")])
        return pa.table({"segments": pa.array([len(own)], pa.int64()), "windows": pa.array([len(where)], pa.int64())})

    return work


class Earliest(Mapped):
    """The shards' reports."""

    def __init__(self, folder: str, shards: int):
        super().__init__(folder)
        self.shards = shards

    def _report(self, shard: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hashes of its segments, where each one's windows begin, first document and first word of each window)."""
        raw = self.file(f"{shard}.report")
        if not len(raw):
            raise FileNotFoundError(f"report of shard {shard} in {self.folder}")
        n = int(raw[:8].view("<i8")[0])
        at = raw[8 + 8 * n:16 + 16 * n].view("<i8")
        end = 16 + 16 * n + 8 * int(at[-1])
        return raw[8:8 + 8 * n].view("<u8"), at, raw[16 + 16 * n:end].view("<i8"), raw[end:].view("<i4")

    def repeated(self, shard: np.ndarray, key: np.ndarray, count: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
        """For the windows of all segments, one after the other: whether their words begin earlier too."""
        first = np.cumsum(count) - count
        out = np.zeros(int(count.sum()), bool)
        by = np.argsort(shard, kind="stable")
        cut = np.flatnonzero(np.diff(shard[by], prepend=-1))
        for a, z in zip(cut, np.append(cut[1:], len(by))):
            own = by[a:z]
            keys, at, docs, words = self._report(int(shard[by[a]]))
            k = np.minimum(np.searchsorted(keys, key[own]), len(keys) - 1)
            if not (keys[k] == key[own]).all():
                raise ValueError("the texts have changed since they were indexed")
            n = count[own]
            theirs, _ = _slices(np.arange(int(at[-1])), at[k], n)
            ours, _ = _slices(np.arange(len(out)), first[own], n)
            step = np.arange(len(ours)) - np.repeat(np.cumsum(n) - n, n)
            d, w = np.repeat(doc[own], n), np.repeat(start[own], n) + step
            out[ours] = (docs[theirs] < d) | ((docs[theirs] == d) & (words[theirs] < w))
        return out


def _removal(window: int, gram: int, anchors: KeySet, grams: KeySet, report: Earliest, names: list[str]):
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def work(batches):
        for b, x, y, t in _each(batches, window, gram):
            _chosen(t, anchors, grams)
            at, count, key = t.segments()
            step = np.zeros(len(t.codes) + 1, np.int64)
            if len(at):
                row = t.owners(at)
                shard = _shard_of(t.grams[t.anchors[np.searchsorted(t.starts, at)]], report.shards)
                again = t.starts[report.repeated(shard, key, count, _ids(b.column(1).slice(x, y - x))[row], at - t.first[row])]
                step[again] += 1
                step[again + window] -= 1
            gone = np.cumsum(step)[:-1] > 0
            begins = np.zeros(len(gone) + 1, bool)  # where a text begins or ends: runs of removed words are cut there
            begins[t.first] = True
            lo = np.flatnonzero(gone & (begins[:-1] | ~np.concatenate([[False], gone[:-1]])))
            hi = np.flatnonzero(gone & (begins[1:] | ~np.concatenate([gone[1:], [False]]))) + 1
            kept, cuts = [], []
            text = b.column(0)
            bounds = np.searchsorted(lo, t.first)
            for r in range(x, y):
                a, z = t.first[r - x], t.first[r - x + 1]
                words = (text[r].as_py() or "").encode("utf-8", "surrogatepass").split()
                i, j = bounds[r - x], bounds[r - x + 1]
                if i < j:
                    words = compress(words, ~gone[a:z])
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                cuts.append([{"start": int(u - a), "end": int(v - a)} for u, v in zip(lo[i:j], hi[i:j])])
            yield pa.RecordBatch.from_arrays(
                [b.column(1).slice(x, y - x), pa.array(np.diff(t.first), pa.int64()), pa.array(cuts, spans_type),
                 pa.array(kept, pa.string())], names)

    return work


def removed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW,
            gram: int = GRAM) -> DataFrame:
    """(id, n_words, spans, kept) of every row: the word spans removed and the words left, joined by spaces.

    ``id_col`` is a column of whole numbers; the smaller one is the earlier document.
    """
    gram = min(gram, window)
    spark = docs.sparkSession
    texts = docs.select(F.col(text).alias("_text"), F.col(id_col).alias("_id"))
    anchors = _repeated(texts, window, gram, lambda t: t.grams[t.distinct_anchors()])

    def all_places(t: Texts) -> np.ndarray:
        t.with_anchor_in(anchors)
        return t.grams[t.covered_grams()]
    grams = _repeated(texts, window, gram, all_places)
    shards = max(-(-grams.size // SHARD), 1)
    folder = shared_folder(spark, "earliest")
    sent = texts.mapInArrow(_segments(window, gram, anchors, grams, shards),
                            "shard int, key long, doc long, start int, codes binary")
    sent.groupBy("shard").applyInArrow(_index(folder, window), "segments long, windows long").agg(F.sum("windows")).first()
    schema = T.StructType([docs.schema[id_col], T.StructField("n_words", T.LongType()),
                           T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                                            T.StructField("end", T.LongType())]))),
                           T.StructField("kept", T.StringType())])
    return texts.mapInArrow(_removal(window, gram, anchors, grams, Earliest(folder, shards), schema.names), schema)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return removed(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", size.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


QUERIES = {"op11_substring_dedup": op11_substring_dedup}
