"""Benchmark decontamination by the q-gram lemma.

An item of m characters and a stretch of text within k edits of it share at
least m + 1 - q(k + 1) q-grams, whose places differ by at most k: all of them
fall on diagonals (place in the text less place in the item) of one band of
2(k + 1), if such bands begin every k + 1 diagonals.  So shared q-grams are
counted for each text, item and band, bands below the bound are dropped, and the
rest are verified by an alignment that stays in the band (widened by k).  Long
items, whose bands have thousands of columns, are aligned with the same stretch of
text by whole columns, one bit for each of their characters.

Characters are compared lower-cased, any white space as a space.  The edit
budget of an item is ``rate`` of its length, less where the lemma needs it
(k = m // q - 1 at most, so that the bound is at least 1).

Defined results: items that are null or shorter than ``q`` characters are never
found (too short to tell a leak); null and empty texts hold nothing; equal items
and repeated rows are each reported; an empty table gives no rows; columns that
are not named are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, read, utf8

Q = 8
RATE = 0.1
#: Characters of benchmark items in one block; a larger benchmark takes several passes over the texts.
BLOCK_CHARS = 4_000_000
#: Shared q-grams (runs of them) counted in one round.
ROUND = 150_000
#: Items of more characters are aligned by `bit_parallel`; `banded` counts in 16 bits.
LONG = 2_000
_P = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22


@lru_cache(1)
def _fold() -> np.ndarray:
    """Lower-case form of each character that has one of one character; white space becomes a space."""
    out = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x10000):
        if 0xD800 <= c < 0xE000:
            continue
        low = chr(c).lower()
        out[c] = 32 if chr(c).isspace() else ord(low) if len(low) == 1 else c
    return out


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(folded code points of all texts, offsets in code points) from UTF-8 bytes."""
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), "<u4")
    return _fold()[points], before[offsets]


def grams(points: np.ndarray, offsets: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the q-gram at each place, whether it lies within one text)."""
    n = len(points) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    h = points[:n].astype(np.uint64)
    for j in range(1, q):
        h *= _P
        h += points[j:n + j]
    h ^= h >> np.uint64(29)
    inside = np.ones(n, bool)
    for j in range(1, q):  # places less than q before the next text's start
        at = offsets[1:-1] - j
        inside[at[(at >= 0) & (at < n)]] = False
    return h, inside


class Items:
    """A block of benchmark items with the places of their q-grams."""

    def __init__(self, ids: list, texts: list[str], q: int = Q, rate: float = RATE):
        self.q, self.ids = q, ids
        data, offs = utf8(pa.array(texts, pa.string()))
        self.points, self.first = characters(data, offs)
        self.size = np.diff(self.first)
        self.budget = np.maximum(np.minimum((self.size * rate).astype(np.int64), self.size // q - 1), 0)
        self.bound = self.size + 1 - q * (self.budget + 1)
        h, inside = grams(self.points, self.first, q)
        at = np.flatnonzero(inside)
        at = at[np.argsort(h[at], kind="stable")]
        item = np.searchsorted(self.first, at, "right") - 1
        place = at - self.first[item]
        # places of a q-gram that follow each other in an item (a rule of dashes, padding) are one run
        h = h[at]
        new = np.ones(len(at), bool)
        new[1:] = (h[1:] != h[:-1]) | (item[1:] != item[:-1]) | (place[1:] != place[:-1] + 1)
        cut = np.flatnonzero(new)
        self.item, self.place, self.length = item[cut], place[cut], np.diff(np.append(cut, len(at)))
        self.grams, begin = np.unique(h[cut], return_index=True)
        self.begin = np.append(begin, len(cut))
        self.known = np.zeros(1 << _BITS, bool)
        self.known[self._slot(self.grams)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - _BITS)

    def regions(self, points: np.ndarray, offsets: np.ndarray):
        """(text, item, first diagonal of the band) of every band with enough shared q-grams."""
        none = (np.zeros(0, np.int64),) * 3
        h, inside = grams(points, offsets, self.q)
        at = np.flatnonzero(self.known[self._slot(h)] & inside) if len(h) else np.zeros(0, np.int64)
        if not len(at) or not len(self.grams):
            return none
        gram = np.searchsorted(self.grams, h[at])
        hit = self.grams[np.minimum(gram, len(self.grams) - 1)] == h[at]
        at, gram = at[hit], gram[hit]
        text = np.searchsorted(offsets, at, "right") - 1
        found = [none]
        times = np.diff(self.begin)[gram]
        shift = int(self.size.max() + self.budget.max()) + 1  # diagonals may be negative
        bands = int(np.diff(offsets).max()) + shift + 2
        keys = counts = np.zeros(0, np.int64)
        # places with many partners are expanded in rounds of bounded size; what a text got so far is carried on
        rounds = np.cumsum(times) // ROUND
        cuts = np.append(np.flatnonzero(np.diff(rounds, prepend=-1)), len(at))
        for x, y in zip(cuts, cuts[1:]):
            k = times[x:y]
            row = np.repeat(np.arange(x, y), k)
            run = self.begin[gram[row]] + np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
            item = self.item[run]
            width = self.budget[item] + 1
            high = at[row] - offsets[text[row]] - self.place[run] + shift  # diagonals of the run's places
            low = high - self.length[run] + 1
            first = low // width
            k = high // width - first + 1
            own = np.repeat(np.arange(len(row)), k)
            band = first[own] + np.arange(len(own)) - np.repeat(np.cumsum(k) - k, k)
            w = width[own]
            shared = np.minimum(high[own], (band + 1) * w - 1) - np.maximum(low[own], band * w) + 1
            key = (text[row[own]] * len(self.ids) + item[own]) * bands + band
            keys, counts = _added(np.concatenate([keys, key]), np.concatenate([counts, shared]))
            done = np.searchsorted(keys, text[y] * len(self.ids) * bands) if y < len(at) else len(keys)
            # a band of 2 widths begins at every width: a q-gram counts for its own and the one before
            both, count = _added(np.concatenate([keys[:done], keys[:done] - 1]), np.concatenate([counts[:done]] * 2))
            keys, counts = keys[done:], counts[done:]
            band, rest = both % bands, both // bands
            item, owner = rest % len(self.ids), rest // len(self.ids)
            enough = count >= self.bound[item]
            item, owner, band = item[enough], owner[enough], band[enough]
            found.append((owner, item, band * (self.budget[item] + 1) - shift))
        return tuple(np.concatenate(x) for x in zip(*found))

    def verify(self, points: np.ndarray, offsets: np.ndarray, owner, item, diagonal, batch: int = 512):
        """(edits, end) of the best alignment of each region, end counted in the text's characters."""
        edits, end = np.zeros(len(item), np.int64), np.zeros(len(item), np.int64)
        budget, size = self.budget[item], self.size[item]
        low = diagonal - budget
        top = offsets[owner + 1] - offsets[owner]
        other = []
        for r in range(len(item)):  # an exact copy needs no alignment
            a = max(int(low[r]), 0)
            b = min(int(low[r] + size[r] + 4 * budget[r] + 1), int(top[r]))
            own = self.points[self.first[item[r]]:self.first[item[r] + 1]].tobytes()
            stretch = points[offsets[owner[r]] + a:offsets[owner[r]] + max(a, b)].tobytes()
            at = stretch.find(own)
            while at % 4 and at >= 0:
                at = stretch.find(own, at + 1)
            if at >= 0:
                end[r] = a + at // 4 + size[r]
            elif size[r] > LONG:
                edits[r], at = bit_parallel(np.frombuffer(own, np.uint32), np.frombuffer(stretch, np.uint32), int(budget[r]))
                end[r] = a + at
            else:
                other.append(r)
        other = np.array(other, np.int64)
        other = other[np.argsort(size[other], kind="stable")]
        for i in range(0, len(other), batch):
            rows = other[i:i + batch]
            width = 4 * budget[rows] + 2
            reach = int(size[rows].max() + width.max())
            place = low[rows, None] + np.arange(reach)
            stretch = points[np.clip(offsets[owner[rows], None] + place, 0, len(points) - 1)]
            stretch[(place < 0) | (place >= top[rows, None])] = _NOTHING
            own = self.points[np.minimum(self.first[item[rows], None] + np.arange(int(size[rows].max())),
                                         len(self.points) - 1)]
            edits[rows], at = banded(own, size[rows], stretch, width)
            end[rows] = np.minimum(low[rows] + size[rows] + at, top[rows])
        return edits, end


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[cut], np.add.reduceat(counts[order], cut)


_FAR = np.int16(1 << 14)
_NOTHING = 0xFFFFFFFF  # before and after a text: equal to no character


def banded(item: np.ndarray, size: np.ndarray, stretch: np.ndarray, own: np.ndarray):
    """Edit distances of whole items to their stretches of text, within the band; rows together.

    Column c of row i stands for place i + c of the stretch; row i holds the
    cheapest alignment of the item's first i characters that ends there.  An
    alignment may begin and end anywhere in the band of ``own`` columns.
    Outside the text a character of the item costs as much as leaving it out.
    For items of up to about 16,000 characters: costs are counted in 16 bits.
    Returns (edits, column of the cheapest end).
    """
    width = int(own.max())
    cols = np.arange(width, dtype=np.int16)
    fence = np.where(cols < own[:, None], 0, _FAR).astype(np.int16)
    cost = fence.copy()
    best, at = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
    for i in range(1, int(size.max()) + 1):
        step = cost + (stretch[:, i - 1:i - 1 + width] != item[:, i - 1:i])
        np.minimum(step[:, :-1], cost[:, 1:] + np.int16(1), out=step[:, :-1])  # the item's character is missing
        step -= cols
        np.minimum.accumulate(step, axis=1, out=step)                          # the text has characters more
        step += cols
        cost = np.maximum(step, fence)
        ends = np.flatnonzero(size == i)
        if len(ends):
            at[ends] = cost[ends].argmin(axis=1)
            best[ends] = cost[ends, at[ends]]
    return best, at


def bit_parallel(item: np.ndarray, stretch: np.ndarray, budget: int) -> tuple[int, int]:
    """(edits, end) of the whole item's best alignment that lies in the stretch, for items too long for `banded`.

    One column of the edit matrix is two integers of as many bits as the item has
    characters, so a column takes a few operations on whole integers and
    memory in proportion to the item.  Once the edits left can't come below the
    best found, or below the budget, by the end of the stretch, it stops.
    """
    masks = {int(c): int.from_bytes(np.packbits(item == c, bitorder="little").tobytes(), "little") for c in np.unique(item)}
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    up, down, score = full, 0, len(item)
    best, at, left = score, 0, len(stretch)
    for j, c in enumerate(stretch.tolist(), 1):
        same = masks.get(c, 0)
        keep = (((same & up) + up) ^ up) | same | down
        more, less = down | (full & ~(keep | up)), keep & up
        if more & top:
            score += 1
        elif less & top:
            score -= 1
        more, less = (more << 1) & full, (less << 1) & full
        up, down = less | (full & ~(keep | more)), more & keep
        if score < best:
            best, at = score, j
        left -= 1
        if score - left >= min(best, budget + 1):
            break
    return best, at


def _leaks(items: Items, points, offsets):
    """(text, item, end, edits) of verified leaks; of overlapping ones of an item the closest."""
    owner, item, diagonal = items.regions(points, offsets)
    if not len(item):
        return []
    edits, end = items.verify(points, offsets, owner, item, diagonal)
    ok = edits <= items.budget[item]
    best: list = []
    for o, i, e, x in sorted(zip(owner[ok].tolist(), item[ok].tolist(), end[ok].tolist(), edits[ok].tolist())):
        if best and best[-1][:2] == [o, i] and e - best[-1][2] <= items.size[i] // 2:
            if x < best[-1][3]:
                best[-1] = [o, i, e, x]
        else:
            best.append([o, i, e, x])
    return best


def _blocks(benchmark: DataFrame, item_id: str, text: str):
    """Items in blocks of a bounded number of characters, in the order of their hash; never more than
    one block on the driver."""
    rows = benchmark.where(F.length(text) >= Q).select(F.col(item_id).alias("id"), F.col(text).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // BLOCK_CHARS))
    for b in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("text", "id"), F.lit(n)) == b)
        got = sorted(((r.id, r.text) for r in part.collect()), key=lambda r: (r[0] is None, r[0], r[1]))
        if got:
            yield Items([i for i, _ in got], [t for _, t in got])


def _each(batch, column: int, items: Items):
    data, offs = utf8(batch.column(column))
    for x, y in chunks(offs):
        points, first = characters(data[offs[x]:offs[y]], offs[x:y + 1] - offs[x])
        for o, i, end, edits in _leaks(items, points, first):
            yield x + o, i, end, edits


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """(id, item id, start, end, edits, item_chars) of every stretch of a text within an item's
    edit budget; start is the end less the item's length (exact where nothing was added or lost)."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField(item_id, benchmark.schema[item_id].dataType),
                           *[T.StructField(c, T.LongType()) for c in ("start", "end", "edits", "item_chars")]])
    spark = docs.sparkSession
    out = None
    for items in _blocks(benchmark, item_id, item_text):
        sent = spark.sparkContext.broadcast(items)

        def work(batches, sent=sent):
            for b in batches:
                it = sent.value
                found = list(_each(b, 0, it))
                rows, own = [f[0] for f in found], [f[1] for f in found]
                size = it.size[own].astype(np.int64) if own else np.zeros(0, np.int64)
                end = np.array([f[2] for f in found], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(1).take(pa.array(rows, pa.int64())), pa.array([it.ids[i] for i in own], kinds[1]),
                     pa.array(np.maximum(end - size, 0)), pa.array(end),
                     pa.array([f[3] for f in found], pa.int64()), pa.array(size)], schema.names)

        from pyspark.sql.pandas.types import to_arrow_type
        kinds = [to_arrow_type(f.dataType) for f in schema]
        part = docs.select(F.col(text).alias("_text"), F.col(id_col)).mapInArrow(work, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item."""
    spark = docs.sparkSession
    names, column = docs.columns, docs.columns.index(text)
    docs = docs.toDF(*[f"_in{i}" for i in range(len(names))])  # any name is allowed, also one with a dot
    for items in _blocks(benchmark, item_id, item_text):
        sent = spark.sparkContext.broadcast(items)

        def work(batches, sent=sent, column=column):
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[[f[0] for f in _each(b, column, sent.value)]] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(work, docs.schema)
    return docs.toDF(*names)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {"op8_decontamination": op8_decontamination}
