from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from ticketflow.llm import simhash as S

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fp(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    sh = [" ".join(w[i:i + 4]) for i in range(max(len(w) - 3, 1))] if w else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs))


def brute(rows):
    fps = [brute_fp(t) for _, t in rows]
    n = len(rows)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                root[find(i)] = find(j)
    low = {}
    for i in range(n):
        if rows[i][0] is not None:
            low[find(i)] = min(low.get(find(i), rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], f"{fps[i]:016x}", low.get(find(i))) for i in range(n)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(S.op2_simhash(spark, SF)) == brute(rows)


def test_edges(make_docs):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(50)]
    long = " ".join(rnd.choice(words) for _ in range(60000))
    rows = [(5, None), (3, ""), (9, " \n\t"), (7, "one"), (8, "ONE"), (11, "a b c"), (12, "a b c d"), (None, "one"),
            (7, "one"), (20, long), (21, long + " w1"), (22, "ÄÖ x y z"), (None, "nobody else says this")]
    rows += [(100 + i, " ".join(words[:40]) + f" tail{i}") for i in range(30)]
    docs = make_docs(rows)
    assert got(S.near_duplicates(docs)) == brute(rows)
    for parts in (4,):
        assert got(S.near_duplicates(docs, tile_rows=7, parts=parts)) == brute(rows)


def test_empty_and_extra_columns(spark, make_docs):
    assert S.near_duplicates(make_docs([])).collect() == []
    from pyspark.sql import functions as F
    docs = make_docs([(1, "x y"), (2, "x y")]).withColumn("fp", F.lit("a")).withColumn("component_id", F.lit(3))
    assert got(S.near_duplicates(docs)) == brute([(1, "x y"), (2, "x y")])
    kept = S.deduplicate(docs)
    assert [r.doc_id for r in kept.collect()] == [1] and kept.columns == docs.columns


def test_tile_links_are_whole():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = base[:, None] ^ (np.uint64(1) << rng.integers(0, 64, (40, 6)).astype(np.uint64))
    f = np.unique(np.concatenate([base, flips.ravel()]))
    x, y = S.tile_links(f, None, 4, block=5)
    near = {(a, b) for a in f.tolist() for b in f.tolist() if a < b and bin(a ^ b).count("1") <= 4}

    def classes(pairs):
        root = {v: v for v in f.tolist()}

        def find(v):
            while root[v] != v:
                v = root[v]
            return v
        for a, b in pairs:
            root[find(a)] = find(b)
        groups = {}
        for v in root:
            groups.setdefault(find(v), set()).add(v)
        return sorted(map(sorted, groups.values()))
    assert classes(zip(x.tolist(), y.tolist())) == classes(near)
    assert len(x) < len(f)
