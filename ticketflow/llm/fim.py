"""Fill-in-the-middle: documents cut at two token borders and written in another order.

A token is a word with the white space before it, or white space at a text's end.
Where the cuts fall follows from token counts, and those are memoized by content:

* a rolling hash over the last 32 bytes cuts each text into chunks, so the same
  passage gives the same chunks wherever it stands;
* a chunk's boundary summary (code points, runs of word characters, whether it
  begins and ends inside a word) is kept in a bounded cache of the worker, found
  by the chunk's hash and used only if the cached bytes are the same;
* summaries combine from left to right: two runs that meet at a chunk border are
  one word.  The running counts name the chunk of a cut, and only that chunk (and
  those its word runs on into) is looked at again.

The order comes from sha256 of seed and id, so it does not depend on partitions,
other rows or the machine.  All of it is one pass without a shuffle; a lost task
is simply run again.

Defined results: a null text is an empty one, and an empty text is plain with
n = 0; a text that holds one of the marks is plain, so every output can be read
back; a null id counts as empty text in the hash; repeated rows are each
rendered; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, read, utf8

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Of 100 texts, how many are left as they are not; and of those, how many put the suffix first.
FIM_RATE, SPM_RATE = 50, 80

#: Chunks have 2^AVERAGE_BITS bytes in the mean and LONGEST at most.
AVERAGE_BITS, LONGEST = 9, 8192
#: Bytes that a worker's summaries and their chunks may take, and what an entry takes beside its chunk.
CACHE_BYTES = 32 << 20
ENTRY_BYTES = 400

_GEAR = np.random.default_rng(77).integers(0, 2**32, 256, dtype=np.uint32)
_WINDOW = 32
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_WHITE = frozenset(b" \t\n\x0b\x0c\r")


def borders(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sorted byte places where chunks begin (every text's start is one) and the end of the last."""
    n = len(data)
    if not n:
        return np.zeros(1, np.int64)
    h = _GEAR[data]
    for k in (1, 2, 4, 8, 16):  # h[i] = sum of gear[data[i - j]] << j over the last 32 bytes
        older = h[:-k] << np.uint32(k)
        h[k:] += older
    at = np.flatnonzero(h >> np.uint32(32 - AVERAGE_BITS) == 0) + 1
    begin = offsets[np.searchsorted(offsets, at - 1, "right") - 1]
    at = at[at - begin >= _WINDOW]                      # the window lies within the text
    at = at[at < n]
    at = at[(data[at] & 0xC0) != 0x80]                  # never inside a character
    cuts = np.unique(np.concatenate([at, offsets]))
    gap = np.diff(cuts)
    long = np.flatnonzero(gap > LONGEST)
    if len(long):
        times = (gap[long] - 1) // LONGEST
        more = np.repeat(cuts[long], times) + LONGEST * (np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + 1)
        for _ in range(3):
            more -= (data[more] & 0xC0) == 0x80
        cuts = np.unique(np.concatenate([cuts, more]))
    return cuts


def summary(chunk: bytes) -> tuple[int, int, bool, bool]:
    """(code points, runs of word characters, begins inside a word, ends inside a word)."""
    return (len(chunk.decode("utf-8", "surrogatepass")), len(_WORD.findall(chunk)),
            chunk[0] not in _WHITE, chunk[-1] not in _WHITE)


class Memo:
    """Boundary summaries by content; the oldest go when they and their chunks take more than ``room`` bytes."""

    def __init__(self, room: int = CACHE_BYTES):
        self.room, self.held, self.known = room, 0, {}
        self.hits = self.misses = 0

    def __call__(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        key = xxhash.xxh3_64_intdigest(chunk)
        found = self.known.get(key)
        if found is not None and found[0] == chunk:
            self.hits += 1
            return found[1]
        self.misses += 1
        got = summary(chunk)
        if found is None:  # of two contents with one hash the first stays known
            self.known[key] = (chunk, got)
            self.held += len(chunk) + ENTRY_BYTES
            while self.held > self.room and len(self.known) > 1:
                self.held -= len(self.known.pop(next(iter(self.known)))[0]) + ENTRY_BYTES
        return got


class Cuts:
    """Token count and token borders of one text, from the summaries of its chunks."""

    def __init__(self, parts: list[bytes], memo: Memo):
        self.parts = parts
        self.chars, self.words, self.joined = [0], [0], []
        inside = False
        for p in parts:
            chars, runs, begins, ends = memo(p)
            meets = inside and begins
            self.joined.append(meets)
            self.chars.append(self.chars[-1] + chars)
            self.words.append(self.words[-1] + runs - meets)
            inside = ends
        self.n = self.words[-1] + (bool(parts) and not inside)

    def end_of(self, k: int) -> int:
        """Code points of the first ``k`` tokens."""
        if k == 0:
            return 0
        if k > self.words[-1]:
            return self.chars[-1]
        i = bisect_left(self.words, k) - 1  # the chunk in which word k begins
        rank = k - self.words[i] + self.joined[i]
        for run in _WORD.finditer(self.parts[i]):
            rank -= 1
            if not rank:
                break
        end = run.end()
        while end == len(self.parts[i]) and i + 1 < len(self.parts) and self.joined[i + 1]:
            i += 1
            end = _WORD.match(self.parts[i]).end()
        return self.chars[i] + len(self.parts[i][:end].decode("utf-8", "surrogatepass"))


def rendered(text: str, form: str, first: int, second: int) -> str:
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def _work(names: list[str], fim_rate: int, spm_rate: int):
    def work(batches):
        memo = Memo()
        for b in batches:
            data, offs = utf8(b.column(0))
            draws = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(1, 5)], 1).astype(np.int64)
            for x, y in chunks(offs):
                raw = data[offs[x]:offs[y]].tobytes()  # of one range: a batch may be large
                own = offs[x:y + 1] - offs[x]
                at = borders(np.frombuffer(raw, np.uint8), own)
                first = np.searchsorted(at, own).tolist()
                at, own = at.tolist(), own.tolist()
                rows = []
                for r in range(x, y):
                    i = r - x
                    marks = at[first[i]:first[i + 1] + 1]
                    cuts = Cuts([raw[a:z] for a, z in zip(marks, marks[1:])], memo)
                    n = cuts.n
                    h1, h2, h3, h4 = draws[r].tolist()
                    text = raw[own[i]:own[i + 1]].decode("utf-8", "surrogatepass")
                    if not n or h3 % 100 >= fim_rate or PREFIX in text or SUFFIX in text or MIDDLE in text:
                        rows.append((n, "plain", None, None, text))
                        continue
                    a, z = sorted((h1 % (n + 1), h2 % (n + 1)))
                    a, z = cuts.end_of(a), cuts.end_of(z)
                    form = "spm" if h4 % 100 < spm_rate else "psm"
                    rows.append((n, form, a, z - a, rendered(text, form, a, z)))
                types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                out = pa.RecordBatch.from_arrays(
                    [b.column(5).slice(x, y - x), *[pa.array(c, t) for c, t in zip(zip(*rows), types)]], names)
                del raw, rows
                yield out
            b = data = out = None  # the batch goes before the next is read

    return work


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text: str = "text", seed: int = SEED,
                   fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row; ``output`` is the training text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"_h{i + 1}") for i in range(4)]
    schema = T.StructType([docs.schema[id_col], *[T.StructField(*f) for f in (
        ("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()),
        ("middle_chars", T.LongType()), ("output", T.StringType()))]])
    return (docs.select(F.col(text).alias("_text"), *draws, F.col(id_col))
            .mapInArrow(_work(schema.names, fim_rate, spm_rate), schema))


def restored(output: str = "output", form: str = "form") -> Column:
    """The text again, from what was written: no part holds a mark, so the marks are where they are first found.

    The places of the two later marks are looked for once a row and named by one-element
    arrays, as a plain expression would cut the text anew wherever it uses them."""
    out = F.col(output)
    second = F.when(F.col(form) == "psm", SUFFIX).otherwise(PREFIX)

    def put(s):
        one = F.substr(out, F.lit(4), s["second"] - 4)
        two = F.substr(out, s["second"] + 3, s["third"] - s["second"] - 3)
        middle = F.substr(out, s["third"] + 3)
        return F.when(F.col(form) == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))

    marks = F.array(F.struct(F.call_function("locate", second, out, F.lit(4)).alias("second"),
                             F.call_function("locate", F.lit(MIDDLE), out, F.lit(4)).alias("third")))
    return F.when(F.col(form) == "plain", out).otherwise(F.transform(marks, put)[0])


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(read(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored().cast("binary"), 256).alias("restored_sha256"))


QUERIES = {"op12_fill_in_middle": op12_fill_in_middle}

ORACLE_SQL = {"op12_fill_in_middle": r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
tokens AS (
  SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
         ('0x' || substr(d, 1, 8))::BIGINT AS h1, ('0x' || substr(d, 9, 8))::BIGINT AS h2,
         ('0x' || substr(d, 17, 8))::BIGINT AS h3, ('0x' || substr(d, 25, 8))::BIGINT AS h4 FROM texts),
cuts AS (
  SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a,
         greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS z FROM tokens),
parts AS (
  SELECT *, array_to_string(w[:a], '') AS p, array_to_string(w[a + 1:z], '') AS m, array_to_string(w[z + 1:], '') AS s,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM cuts)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""}
