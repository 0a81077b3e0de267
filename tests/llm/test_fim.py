from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticketflow.llm import fim as M

SF = "/root/testdata/sf0.001"
TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
sha = lambda t: hashlib.sha256(t.encode()).hexdigest()


def want(doc_id, text):
    text = text or ""
    words = TOKEN.findall(text)
    n = len(words)
    h = [int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, z = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(words[:a]), "".join(words[a:z]), "".join(words[z:])
    form = "spm" if h[3] % 100 < 80 else "psm"
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(out), sha(text)


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256",
                                       "restored_sha256").collect()), key=str)


def digests(docs):
    return rows(M.fill_in_middle(docs).withColumn("output_sha256", F.sha2(F.col("output").cast("binary"), 256))
                .withColumn("restored_sha256", F.sha2(M.restored().cast("binary"), 256)))


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert rows(M.op12_fill_in_middle(spark, SF)) == sorted((want(r.doc_id, r.text) for r in docs), key=str)


def test_edges(spark, make_docs):
    long = "word \t ünï𝄞 " * 200_000
    texts = [None, "", " ", "\n\n", "a", " a ", "a b", "has <P> in", "x<S>", "<M>", "<", "<S", "P> <", "S> a <M", long,
             "z" * 300_000, " " * 50_000 + "x", "same", "same", "ü" * 9000, "𝄞 " * 9000]
    docs = [(i, t) for i in (*range(12), None) for t in texts]
    got = digests(make_docs(docs))
    assert got == sorted((want(*d) for d in docs), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert digests(make_docs([])) == []


def test_clashing_columns(spark, make_docs):
    docs = make_docs([(5, "one two three four")])
    extra = docs.selectExpr("*", "'x' AS n", "'y' AS form", "1 AS _text", "2 AS _h1", "'z' AS output")
    assert digests(extra) == digests(docs)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "bcd", " ", "\n", "ü", "𝄞", "\x1f", "\xa0", "xyzxyzxyz"]), max_size=60).map("".join),
       st.integers(1, 12))
def test_any_chunking_gives_the_same_cuts(text, size):
    raw = text.encode()
    parts, at = [], 0
    while at < len(raw):
        end = min(at + size, len(raw))
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end += 1
        parts.append(raw[at:end])
        at = end
    cuts = M.Cuts(parts, M.Memo(64))
    words = TOKEN.findall(text)
    assert cuts.n == len(words)
    assert [cuts.end_of(k) for k in range(cuts.n + 1)] == [len("".join(words[:k])) for k in range(cuts.n + 1)]


def test_chunks_follow_content(monkeypatch):
    rng = np.random.default_rng(1)
    shared = bytes(rng.integers(97, 123, 20_000, dtype=np.uint8))
    texts = [b"some text before " + shared, shared + b" and after", "é".encode() * 20_000]
    offs = np.cumsum([0, *map(len, texts)])
    at = M.borders(np.frombuffer(b"".join(texts), np.uint8), offs)
    assert set(offs) <= set(at) and (np.diff(at) <= M.LONGEST).all()
    data = b"".join(texts)
    parts = [data[a:z] for a, z in zip(at, at[1:])]
    assert b"".join(parts) == data and [p.decode() for p in parts]
    one, two = ({p for p, a in zip(parts, at) if lo <= a < hi} for lo, hi in zip(offs, offs[1:3]))
    assert len(one & two) > 0.8 * len(two)
    memo = M.Memo()
    for p in parts:
        assert memo(p) == M.summary(p)
    assert memo.hits > 0.8 * len(two)


def test_a_hash_collision_is_told_by_content(monkeypatch):
    monkeypatch.setattr(M.xxhash, "xxh3_64_intdigest", lambda b: 7)
    memo = M.Memo()
    assert [memo(p) for p in (b"one", b"t w o", b"one", b"t w o")] == [M.summary(p) for p in (b"one", b"t w o") * 2]
    assert memo.hits == 1


@pytest.mark.parametrize("rates", [(0, 0), (100, 0), (100, 100)])
def test_rates(spark, make_docs, rates):
    got = M.fill_in_middle(make_docs([(i, "a b c") for i in range(20)]), fim_rate=rates[0], spm_rate=rates[1]).collect()
    assert {r.form for r in got} == {"plain" if not rates[0] else "spm" if rates[1] else "psm"}


def test_a_worker_holds_one_range_of_a_batch_beside_it(monkeypatch):
    """Python's own memory follows the ranges and the cache's stated bytes, not the batch."""
    import tracemalloc

    import pyarrow as pa
    monkeypatch.setattr(M.Memo.__init__, "__defaults__", (1 << 20,))
    rng = np.random.default_rng(3)
    n, size = 6000, 10_000
    texts = pa.array([bytes(rng.integers(96, 123, size, dtype=np.uint8)).replace(b"`", b" ").decode() for _ in range(n)], pa.large_string())
    batch = pa.RecordBatch.from_arrays([texts, *[pa.array(rng.integers(0, 2**32, n)) for _ in range(4)], pa.array(range(n))],
                                       ["_text", "a", "b", "c", "d", "doc_id"])
    work = M._work(["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"], 50, 80)
    tracemalloc.start()
    try:
        assert sum(out.num_rows for out in work(iter([batch]))) == n
        assert tracemalloc.get_traced_memory()[1] < 0.75 * n * size  # the batch's own 60 MB are Arrow's, not counted
        tracemalloc.reset_peak()
        memo, before = M.Memo(1 << 20), tracemalloc.get_traced_memory()[0]
        for i in range(20_000):
            memo(b"some words %d" % i)
        assert tracemalloc.get_traced_memory()[0] - before < 2 << 20
    finally:
        tracemalloc.stop()
