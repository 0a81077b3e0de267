"""SimHash near-duplicates by tiled exact comparison.

Every text gets a 64-bit fingerprint of its word shingles.  Distinct
fingerprints are cut into tiles by their population counts: of the whole
fingerprint, or of its halves, quarters or bytes where there are more of them.
The difference of the counts, summed over the parts, is a lower bound of the
bit distance, so a pair of tiles whose counts differ beyond the radius is
skipped unseen.  All other pairs of tiles are compared whole with exclusive-or
and bit counts; nothing is sampled and no tile is capped.

Defined results: a null or empty text has no words and fingerprint 0, which
links like any other; repeated rows give one result row each; rows with a null
id get the class of their fingerprint (null if nobody in it has an id); an
empty table gives no rows; columns that are not named are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CHUNK_BYTES, chunks, read, stored, utf8
from .components import components
from .tokens import LOWER, spans

SEED = 42
_LANES = np.uint64(0x0101010101010101)


def _bit_sums(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts, 64): how many hashes of each text have bit k set; texts own consecutive hashes."""
    out = np.zeros((len(first) - 1, 64), np.int64)
    if not len(h):
        return out
    # runs of at most 255 hashes, so that eight one-byte sums fit in a word
    sizes = np.diff(first)
    runs = -(-sizes // 255)
    owner = np.repeat(np.arange(len(sizes)), runs)
    base = np.repeat(np.cumsum(runs) - runs, runs)
    begin = first[:-1][owner] + (np.arange(len(owner)) - base) * 255
    for k in range(8):
        lanes = np.add.reduceat((h >> np.uint64(k)) & _LANES, begin)
        counts = lanes.astype("<u8").view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            np.add.at(out[:, byte * 8 + k], owner, counts[:, byte])
    return out


def fingerprints(data: np.ndarray, offsets: np.ndarray, words: int) -> np.ndarray:
    """uint64 fingerprints of the texts in ``data`` (UTF-8 bytes); a text without words gets 0."""
    low = LOWER[data]
    s, e, first = spans(low, offsets)
    n = np.diff(first)
    # the texts again with one space between words: shingles are then plain slices
    raw = low.tobytes()
    joined = b" ".join([raw[a:b] for a, b in zip(s.tolist(), e.tolist())])
    size = e - s
    begin = np.cumsum(size + 1) - size - 1
    end = begin + size
    shingles = np.where(n == 0, 0, np.maximum(n - words + 1, 1))
    hf = np.concatenate([[0], np.cumsum(shingles)])
    owner = np.repeat(np.arange(len(n)), shingles)
    left = first[:-1][owner] + np.arange(len(owner)) - hf[:-1][owner]
    right = np.minimum(left + words, first[1:][owner]) - 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(begin[left].tolist(), end[right].tolist())),
                    np.uint64, len(owner))
    bits = _bit_sums(h, hf) * 2 > shingles[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def with_fingerprint(docs: DataFrame, text: str, keep: list[str], words: int = 4) -> DataFrame:
    """``keep`` columns and ``fp`` (the fingerprint's 64 bits as a long) for every row."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("fp", T.LongType(), False)])

    def work(batches):
        for b in batches:
            data, offs = utf8(b.column(0))
            got = [fingerprints(data[offs[x]:offs[y]], offs[x:y + 1] - offs[x], words)
                   for x, y in chunks(offs, CHUNK_BYTES)]
            fp = np.concatenate(got) if got else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(fp.view(np.int64))], [*keep, "fp"])

    src = docs.select(F.col(text).alias("_text"), *[F.col(c) for c in keep])
    return src.mapInArrow(work, schema)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable index of 0..n-1 under the links a-b."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(up := root[root], root):
            root = up
        if np.array_equal(before, root):
            return root


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int, block: int = 64):
    """(x, y) fingerprints, x linked to y in the same class of this pair of tiles (``right`` None: within one tile).

    Blocks of rows are compared at once and each block's links are merged into
    a forest, so a group of near copies leaves one link for each fingerprint
    however many pairs it has.
    """
    other = left if right is None else right
    shift = 0 if right is None else len(left)
    every = left if right is None else np.concatenate([left, right])
    parent = None
    for i in range(0, len(left), block):
        near = np.bitwise_count(left[i:i + block, None] ^ other[None, :]) <= radius
        x, y = np.nonzero(near)
        x, y = x + i, y + shift
        if right is None:
            later = y > x
            x, y = x[later], y[later]
        if len(x):
            if parent is None:
                parent = np.arange(len(every))
            grown = np.flatnonzero(parent != np.arange(len(every)))
            parent = _forest(np.concatenate([grown, x]), np.concatenate([parent[grown], y]), len(every))
    if parent is None:
        return every[:0], every[:0]
    node = np.flatnonzero(parent != np.arange(len(every)))
    return every[node], every[parent[node]]


#: How many parts have their bits counted, by the number of distinct fingerprints:
#: so many that a tile's cell of counts is still well filled.
PARTS = ((2_000_000, 1), (32_000_000, 2), (3_000_000_000, 4), (1 << 62, 8))
_DIGIT = 128  # counts stand in a key as digits of this base, 8 added so that none runs over


def _offsets(parts: int, radius: int) -> list[int]:
    """Key differences with a summed difference of counts within ``radius``, one of each opposite pair."""
    found = [()]
    for _ in range(parts):
        found = [(*d, x) for d in found for x in range(-radius, radius + 1)
                 if sum(map(abs, d)) + abs(x) <= radius]
    keys = (sum(x * _DIGIT**i for i, x in enumerate(d)) for d in found)
    return sorted(k for k in keys if k >= 0)


def links(fps: DataFrame, radius: int, tile_rows: int = 8192, parts: int | None = None) -> DataFrame:
    """(x, y) links between distinct fingerprints ``fp`` within ``radius`` bits, as forests of tile pairs.

    A tile holds about ``tile_rows`` fingerprints with the same counts; a
    crowded cell of counts has several tiles, dealt by a hash.  Which tiles
    meet is an equi-join on the cell's key and a short list of key differences.
    """
    spark = fps.sparkSession
    if parts is None:
        n = fps.count()
        parts = next(p for most, p in PARTS if n < most)
    bits = 64 // parts
    mask = -1 if parts == 1 else (1 << bits) - 1
    key = F.lit(0).cast("long")
    for i in range(parts):
        part = F.shiftrightunsigned("fp", bits * i).bitwiseAND(F.lit(mask).cast("long"))
        key = key + (F.bit_count(part).cast("long") + 8) * F.lit(_DIGIT**i).cast("long")
    keyed = fps.select("fp", key.alias("key"))
    sizes = keyed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile_rows)).cast("int").alias("tiles"))
    dealt = (keyed.join(sizes, "key")
             .select("key", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("tiles")).cast("int").alias("part"), "fp"))

    def pack(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().astype("<i8")
        return pa.table({"key": table.column("key")[:1], "part": table.column("part")[:1],
                         "fps": pa.array([fp.tobytes()], pa.binary())})

    tiles = stored(dealt.groupBy("key", "part").applyInArrow(pack, "key long, part int, fps binary"), "tiles")
    heads = tiles.select("key", "part")
    differences = F.array(*[F.lit(d).cast("long") for d in _offsets(parts, radius)])
    asked = heads.select("key", "part", F.explode(F.transform(differences, lambda d: d + F.col("key"))).alias("okey"))
    met = asked.join(heads.select(F.col("key").alias("okey"), F.col("part").alias("opart")), "okey")
    met = stored(met.where((F.col("key") != F.col("okey")) | (F.col("part") <= F.col("opart"))), "met")
    tasks = max(spark.sparkContext.defaultParallelism, -(-met.count() // 16))
    pairs = (met.join(tiles, ["key", "part"])
             .join(tiles.select(F.col("key").alias("okey"), F.col("part").alias("opart"), F.col("fps").alias("ofps")),
                   ["okey", "opart"])
             .select("fps", F.when((F.col("key") != F.col("okey")) | (F.col("part") != F.col("opart")),
                                   F.col("ofps")).alias("ofps")))

    def compare(batches):
        for b in batches:
            for left, right in zip(b.column(0), b.column(1)):
                x, y = tile_links(np.frombuffer(left.as_py(), "<u8"),
                                  np.frombuffer(right.as_py(), "<u8") if right.is_valid else None, radius)
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))],
                                                     ["x", "y"])

    return pairs.repartition(tasks).mapInArrow(compare, "x long, y long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                    radius: int = 4, tile_rows: int = 8192, parts: int | None = None) -> DataFrame:
    """(id, fingerprint, component_id) of every row; component_id is the smallest id
    that links of at most ``radius`` differing bits reach."""
    marked = stored(with_fingerprint(docs, text_col, [id_col], words), "fingerprints")
    fps = stored(marked.groupBy("fp").agg(F.min(id_col).alias("rep")), "distinct")
    labels = components(links(fps.select("fp"), radius, tile_rows, parts), "x", "y")
    rooted = fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(classes, "fp").select(
        F.col(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                radius: int = 4) -> DataFrame:
    """One row of each class of near duplicates, with the columns of ``docs``: the
    row with the smallest id (of repeated rows with that id, the first by all columns).
    Rows without an id cannot be told apart by id and stay."""
    found = near_duplicates(docs, id_col, text_col, words, radius)
    first = found.where(F.col(id_col) == F.col("component_id")).select(id_col).distinct()
    stay = docs.join(first, id_col, "left_semi")
    stay = stay.dropDuplicates([id_col])
    return stay.unionByName(docs.where(F.col(id_col).isNull()))


QUERIES = {"op2_simhash": op2_simhash}
