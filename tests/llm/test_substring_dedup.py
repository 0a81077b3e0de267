from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketflow.llm import substring_dedup as S
from ticketflow.llm.fm_index import FMIndex

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def want(docs, window=20):
    """(id, words, removed, kept) with every window compared by its words."""
    first, texts = {}, [(-2**63 if i is None else i, i, WORD.findall(t or "")) for i, t in docs]
    for o, _, w in texts:
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            first[k] = min(first.get(k, (o, s)), (o, s))
    out = []
    for o, i, w in texts:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < (o, s):
                gone[s:s + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r[0], r.n_words, sum(s.end - s.start for s in r.spans), r.kept) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(map(tuple, S.op11_substring_dedup(spark, SF).select("doc_id", "n_words", "n_removed", "kept_sha256")
                     .collect()), key=str)
    expected = want(docs)
    assert any(r[2] for r in expected)
    assert got == sorted([(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in expected], key=str)


@pytest.mark.parametrize("window", [1, 3, 8, 20])
def test_random_passages(spark, make_docs, monkeypatch, window):
    monkeypatch.setattr(S, "SHARD", 40)       # many shards and arrays
    monkeypatch.setattr(S, "ARRAY", 16)
    monkeypatch.setattr(S, "HELD", 50)        # tasks send early, so shards see a segment twice
    monkeypatch.setattr(S, "HELD_SEGMENTS", 5)
    rnd = random.Random(window)
    words = [f"w{i}" for i in range(40)] + ["ü", "#", "a" * 70]
    passages = [[rnd.choice(words) for _ in range(rnd.randrange(2 * window + 3))] for _ in range(6)]
    docs = []
    for n in range(80):
        parts = [rnd.choice(passages) if rnd.random() < 0.6 else [rnd.choice(words) for _ in range(rnd.randrange(15))]
                 for _ in range(rnd.randrange(5))]
        docs.append((rnd.choice([n, -n, 7, None]) if n % 9 == 0 else n * 3 % 80, rnd.choice([" ", "\n", " \t "]).join(sum(parts, []))))
    assert rows(S.removed(make_docs(docs), window=window)) == want(docs, window)


def test_edges(spark, make_docs):
    line = " ".join(f"word{i}" for i in range(30))
    docs = [(1, None), (2, ""), (3, "short text"), (4, line), (4, line), (5, line), (6, "x " + line + " y"), (None, line),
            (7, "same " * 100), (8, "a b " * 60_000), (9, "z" * 200_000), (10, line + " " + line), (11, " \n\t ")]
    assert rows(S.removed(make_docs(docs))) == want(docs)
    assert rows(S.removed(make_docs([]))) == []
    assert rows(S.removed(make_docs([(1, None), (2, "a b")]))) == [(1, 0, 0, ""), (2, 2, 0, "a b")]


def test_clashing_columns(spark, make_docs):
    line = " ".join(f"word{i}" for i in range(30))
    docs = make_docs([(1, line), (2, line)])
    extra = docs.selectExpr("*", "1 AS h", "2 AS n", "'x' AS kept", "3 AS _id", "'y' AS _text", "4 AS shard", "5 AS key")
    assert rows(S.removed(extra)) == rows(S.removed(docs)) == [(1, 30, 0, line), (2, 30, 30, "")]


def test_a_frequent_passage_brings_no_neighbours(spark, make_docs):
    """A passage in every text: its windows are one set of segments however many texts hold it."""
    rnd = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(40))
    own = lambda n: " ".join(f"u{n}x{rnd.random()}" for _ in range(30))
    docs = [(n, f"{own(n)} {passage} {own(-n)}") for n in range(300)]
    texts = make_docs(docs).select(F.col("text").alias("_text"), F.col("doc_id").alias("_id")).repartition(3)
    anchors = S._repeated(texts, 20, 8, lambda t: t.grams[t.distinct_anchors()])

    def every(t):
        t.with_anchor_in(anchors)
        return t.grams[t.covered_grams()]
    grams = S._repeated(texts, 20, 8, every)
    assert grams.size == 40 - 8 + 1
    sent = texts.mapInArrow(S._segments(20, 8, anchors, grams, 1), "shard int, key long, doc long, start int, codes binary")
    assert sent.count() <= 3 * 21
    assert rows(S.removed(make_docs(docs))) == want(docs)


def test_index_of_other_sequences():
    """Matching statistics and rows of queries that the index does not hold, against plain search."""
    rnd = random.Random(1)
    for trial in range(200):
        window = rnd.randrange(1, 6)
        seqs = [[rnd.randrange(1, 4) for _ in range(rnd.randrange(12))] for _ in range(rnd.randrange(6))]
        asked = [[rnd.randrange(1, 5) for _ in range(rnd.randrange(14))] for _ in range(4)] + seqs
        flat = lambda s: (np.array([x for q in s for x in q], np.uint64), np.cumsum([0, *map(len, s)]))
        index = FMIndex(*flat(seqs), window, rnd.choice([window, 16]))
        codes, first = flat(asked)
        length, row = index.statistics(codes, first)
        held = {tuple(s[i:j]) for s in seqs for i in range(len(s)) for j in range(i, len(s) + 1)} | {()}
        text = [x for s in seqs for x in (*s, 0)]
        for k, q in enumerate(asked):
            for i in range(len(q)):
                best = max(n for n in range(min(window, len(q) - i) + 1) if tuple(q[i:i + n]) in held)
                p = first[k] + i
                assert length[p] == best and (row[p] >= 0) == (best == window)
                if best == window:
                    at = index.order[row[p]]
                    assert text[at:at + window] == q[i:i + window]
