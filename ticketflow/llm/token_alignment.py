"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Both tokenizers encode the same bytes (a space and the text).  The places where
tokens of both end are found as a hash intersection: cumulative ends go into a
dictionary from end to index, the common keys in order slice both id lists into
groups, and within a slice every two tokens whose bytes overlap are a link.  How often two ids are linked is summed over the corpus, and each text
is told how well its links agree with that.

Encoding, the costly part, is done once: a pass writes every text's groups and
its distinct id pairs with their counts.  The corpus counts are a plain Spark
aggregate of those (a pair in every text is one row of a task), joined back by
pair.  The table of counts is broadcast only if its rows, which are counted
first, are at most MOST_SENT; beyond, both sides are shuffled by pair, and a
frequent pair, which has one row a text, is left to adaptive skew splitting.
A task keeps the rows of its last texts, found by the whole text, for copies.

Defined results: a text that is null, empty, or that one of the tokenizers does
not give back byte for byte has no tokens: zeros and an empty digest; repeated
rows and null ids are each a row of their own; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read, shared_folder, stored

#: Where the tokenizers' files lie on every machine.
FOLDER = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Corpus counts of at most so many id pairs (16 bytes each) are broadcast.
MOST_SENT = 2_000_000
#: Characters of texts that a task aligns in one round; a longer text is a round of its own.
HELD = 50_000
#: Characters of texts whose rows a task keeps for copies of them.
KEPT = 8_000_000

#: The public pattern that byte-level BPE of this kind splits texts by (fixed value).
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones
    stand for themselves, the others in order for 256 and on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE file; special tokens' strings inside texts are plain text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        byte, vocab = _byte_of(), model["model"]["vocab"]
        self.bytes = [b""] * (max([*vocab.values(), *[t["id"] for t in model["added_tokens"]]]) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(byte[c] for c in token)
        #: nothing is normalised and every byte has a token, so the tokens of a text give it back
        self.lossless = model.get("normalizer") is None and {bytes([i]) for i in range(256)} <= set(self.bytes)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        before = len(vocab) - len(merges)
        ranked = all(vocab[a + b] == before + i for i, (a, b) in enumerate(merges))
        if ranked and sorted(vocab.values()) == list(range(len(vocab))):
            # ids in the order of merges are ranks: the faster library gives the same ids
            import tiktoken

            encoding = tiktoken.Encoding("byte-level", pat_str=_SPLIT, special_tokens={},
                                         mergeable_ranks={b: i for i, b in enumerate(self.bytes) if b})
            self._encode = encoding.encode_ordinary
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            self._encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._encode(" " + t) for t in texts]


class Pieces:
    """A piece model with byte fallback; it puts a space before the text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in ((i, self.model.id_to_piece(i)) for i in range(size))]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(4)
def _loaded(kind, path: str):
    tokenizer = kind(path)
    return tokenizer, np.array([len(b) for b in tokenizer.bytes])


def groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(end in A's ids, end in B's ids) of every group: the places where tokens of both end.

    B's ends go into a dictionary from end to index; A's, which rise, are probed in
    their order, so the common keys come sorted and A's index is the probe's number.
    """
    index_b = dict(zip(ends_b.tolist(), range(1, len(ends_b) + 1)))
    found = np.fromiter(map(index_b.get, ends_a.tolist(), repeat(0)), np.int64, len(ends_a))
    cut_a = np.flatnonzero(found)
    return cut_a + 1, found[cut_a]


@lru_cache(4)
def _forms(size_a: int, size_b: int) -> list[str]:
    """Every id of A before a comma and before a bar, every id of B before a comma and before a semicolon."""
    return [f"{i}{end}" for size, ends in ((size_a, ",|"), (size_b, ",;")) for end in ends for i in range(size)]


def written(ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, size_a: int, size_b: int) -> list[str]:
    """The pieces of the groups as text, group by group: ids by commas, a bar between the sides, a semicolon after each."""
    last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    last_a[cut_a - 1] = last_b[cut_b - 1] = True
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    form = np.empty(len(ids_a) + len(ids_b), np.int64)
    form[np.arange(len(ids_a)) + np.concatenate([[0], cut_b])[group_a]] = ids_a + last_a * size_a
    form[np.arange(len(ids_b)) + cut_a[group_b]] = 2 * size_a + ids_b + last_b * size_b
    return list(map(_forms(size_a, size_b).__getitem__, form.tolist()))


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in A, place in B) of all tokens whose bytes overlap.

    The slices are expanded together: each A token meets the B tokens from the
    first that ends after its begin to the last that begins before its end, and
    none of them lies beyond a common end.
    """
    start_a = np.concatenate([[0], ends_a[:-1]])
    first = np.searchsorted(ends_b, start_a, "right")
    last = np.searchsorted(ends_b, ends_a, "left")
    size = last - first + 1
    a = np.repeat(np.arange(len(ends_a)), size)
    return a, np.repeat(first - (np.cumsum(size) - size), size) + np.arange(len(a))


def _encoded(a_path: str, b_path: str, names: list[str]):
    def work(batches):
        tok_a, len_a = _loaded(ByteLevel, a_path)
        tok_b, len_b = _loaded(Pieces, b_path)
        bytes_a, bytes_b = tok_a.bytes, tok_b.bytes
        row = TaskContext.get().partitionId() << 36

        def rows(texts):
            """(n_a, n_b, n_groups, n_links, digest, pairs, times) of each text."""
            all_a, all_b, first_a, first_b = [], [], [0], [0]
            for text, a, b in zip(texts, tok_a.encode(texts), tok_b.encode(texts)):
                raw = b" " + text.encode("utf-8", "surrogatepass")
                if text and b"".join(map(bytes_b.__getitem__, b)) == raw and (
                        tok_a.lossless or b"".join(map(bytes_a.__getitem__, a)) == raw):
                    all_a += a
                    all_b += b
                first_a.append(len(all_a))
                first_b.append(len(all_b))
            ids_a, ids_b = (np.frombuffer(array("q", x), np.int64) if x else np.zeros(0, np.int64) for x in (all_a, all_b))
            # both sides cover the same bytes, so the ends of all texts of the round are one rising
            # sequence, and the end of every text is a common one
            ends_a, ends_b = np.cumsum(len_a[ids_a]), np.cumsum(len_b[ids_b])
            cut_a, cut_b = groups(ends_a, ends_b)
            pieces = written(ids_a, ids_b, cut_a, cut_b, len(bytes_a), len(bytes_b))
            digests = [hashlib.sha256("".join(pieces[i + j:k + n])[:-1].encode()).hexdigest() if i < k else ""
                       for i, k, j, n in zip(first_a, first_a[1:], first_b, first_b[1:])]
            at_a, at_b = links(ends_a, ends_b)
            owner = np.searchsorted(np.array(first_a), at_a, "right") - 1
            key = np.sort(owner * (len(bytes_a) * len(bytes_b)) + ids_a[at_a] * len(bytes_b) + ids_b[at_b])
            new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
            times = np.diff(np.append(new, len(key))).astype(np.int32)
            by, pair = np.divmod(key[new], len(bytes_a) * len(bytes_b))
            first = np.searchsorted(by, np.arange(len(texts) + 1)).tolist()
            n_groups = np.diff(np.searchsorted(cut_a, first_a, "right")).tolist()
            n_links = np.bincount(owner, minlength=len(texts)).tolist()
            return [(k - i, n - j, g, li, d, pair[x:y], times[x:y]) for i, k, j, n, g, li, d, x, y in zip(
                first_a, first_a[1:], first_b, first_b[1:], n_groups, n_links, digests, first, first[1:])]

        def sent(ids, done):
            nonlocal row
            cols = list(zip(*done))
            first = np.concatenate([[0], np.cumsum([len(p) for p in cols[5]])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.arange(row, row + len(done))), *[pa.array(c, pa.int64()) for c in cols[:4]],
                 pa.array(cols[4], pa.string()), pa.ListArray.from_arrays(pa.array(first), pa.array(np.concatenate(cols[5]))),
                 pa.ListArray.from_arrays(pa.array(first), pa.array(np.concatenate(cols[6])))], names)
            row += len(done)

        known, size = {}, 0  # rows by whole text, the oldest first
        for b in batches:
            texts = [t or "" for t in b.column(0).to_pylist()]
            x = 0
            while x < len(texts):
                y, new, n = x, {}, 0
                while y < len(texts) and (n + len(texts[y]) <= HELD or not n) and y - x < 2000:
                    if texts[y] not in known and texts[y] not in new:
                        new[texts[y]] = None
                        n += len(texts[y])
                    y += 1
                got = list(new)
                new = dict(zip(got, rows(got))) if got else {}
                yield from sent(b.column(1).slice(x, y - x), [new[t] if t in new else known[t] for t in texts[x:y]])
                known |= new
                size += n
                while size > KEPT:
                    oldest = next(iter(known))
                    size -= len(oldest)
                    del known[oldest]
                x = y

    return work


def aligned(docs: DataFrame, id_col: str = "doc_id", text: str = "text", a_path: str = f"{FOLDER}/{A_FILE}",
            b_path: str = f"{FOLDER}/{B_FILE}") -> DataFrame:
    """One row a text: its id, n_a, n_b, n_groups, n_links, groups_sha256, and its distinct linked id
    pairs (``pairs``, as A id times the size of B's vocabulary plus B id) with how often each is linked in
    it (``times``).  Written to the shared folder, as encoding is worth doing once."""
    spark = docs.sparkSession
    schema = T.StructType([docs.schema[id_col], *[T.StructField(c, T.LongType()) for c in (
        "row", "n_a", "n_b", "n_groups", "n_links")], T.StructField("groups_sha256", T.StringType()),
        T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.IntegerType()))])
    out = docs.select(F.col(text).alias("_text"), F.col(id_col)).mapInArrow(_encoded(a_path, b_path, schema.names), schema)
    path = shared_folder(spark, "aligned")
    # sorted pairs as differences: about half the bytes of plain or dictionary coding
    (out.write.option("parquet.writer.version", "v2").option("parquet.enable.dictionary", "false")
     .option("compression", "zstd").parquet(path))
    return spark.read.schema(out.schema).parquet(path)


def exploded(texts: DataFrame, *keep: str) -> DataFrame:
    """A row for every pair of a text, with ``times``."""
    return texts.select(*keep, F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")


def pair_counts(texts: DataFrame, b_size: int) -> DataFrame:
    """(pair, count, best) over the corpus; best: no A id is linked more often with the pair's B id."""
    counts = stored(exploded(texts).groupBy("pair").agg(F.sum("times").alias("count")), "pair-counts")
    b = F.col("pair") % F.lit(b_size)
    top = counts.groupBy(b.alias("_b")).agg(F.max("count").alias("_top"))
    return stored(counts.withColumn("_b", b).join(top, "_b")
                  .select("pair", "count", (F.col("count") == F.col("_top")).alias("best")), "pair-best")


def agreement(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """(row, n_best, count_sum) of every text with links."""
    sent = F.broadcast(counts) if counts.count() <= MOST_SENT else counts
    return exploded(texts, "row").join(sent, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = aligned(read(spark, sf_dir, "documents"))
    b_size = len(_loaded(Pieces, f"{FOLDER}/{B_FILE}")[0].bytes)
    found = agreement(texts, pair_counts(texts, b_size))
    return texts.drop("pairs", "times").join(found, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")


QUERIES = {"op13_token_alignment": op13_token_alignment}
