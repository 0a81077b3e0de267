from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pytest

from ticketflow.llm import ngram_lm as L
from ticketflow.llm.kn import discounts

from .conftest import crc

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def toks(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(low), "</s>"]


def brute(rows, train):
    """Textbook form with dictionaries: {row number: (n, known, N, base, score)}."""
    big, uni = Counter(), Counter()
    for i in train:
        t = toks(rows[i][1])
        uni.update(t)
        big.update(zip(["<s>", *t[:-1]], t))
    n, v = sum(uni.values()), len(uni)
    cc = Counter(big.values())
    d2 = discounts(*(cc[i] for i in (1, 2, 3, 4)))
    kinds, lead, ones = Counter(w for _, w in big), Counter(), defaultdict(Counter)
    for (a, _), c in big.items():
        lead[a] += c
        ones[a][min(c, 3)] += 1
    ck = Counter(kinds.values())
    d1 = discounts(*(ck[i] for i in (1, 2, 3, 4)))
    total = len(big)

    def disc(c, d):
        return max(c - d[min(c, 3) - 1], 0) if c else 0.0
    left = sum(d1[min(c, 3) - 1] for c in kinds.values()) / total if total else 1.0

    def p1(w):
        return disc(kinds[w], d1) / max(total, 1) + left / (v + 1)

    def p2(a, w):
        if not lead[a]:
            return p1(w)
        gamma = sum(d2[i - 1] * k for i, k in ones[a].items()) / lead[a]
        return disc(big[a, w], d2) / lead[a] + gamma * p1(w)
    out = {}
    for i, (_, text) in enumerate(rows):
        t = toks(text)
        out[i] = (len(t), sum(uni[w] > 0 for w in t), n, sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in t),
                  sum(math.log10(p2(a, w)) for a, w in zip(["<s>", *t[:-1]], t)))
    assert not rows or not total or abs(sum(p2("the", w) for w in uni) + p2("the", "never seen") - 1) < 1e-9
    return out


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(rows, [i for i, (d, _) in enumerate(rows) if crc(d, 7) != 2])
    want = {rows[i][0]: v for i, v in want.items()}
    got = L.op6_lm_scores(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        n, known, total, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, crc(r.doc_id, 7) == 2)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def test_edges(make_docs):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b a b a c"), (4, "a b a b a c"), (None, "b"), (6, "x" * 3_000_000),
            (7, "The the THE"), (8, "the end of the day")]
    docs = make_docs(rows)
    want = brute(rows, [3, 4, 5, 7])
    model = L.train(docs.where("doc_id in (4, 7) or doc_id is null"))
    got = L.score(docs.coalesce(1), model, ["doc_id"]).collect()
    for i, r in enumerate(got):
        n, known, _, base, score = want[i]
        assert (r.n_tokens, r.n_known) == (n, known)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)
    none = L.train(make_docs([]))
    assert [(r.n_tokens, r.score) for r in L.score(make_docs([(1, "a")]), none, ["doc_id"]).collect()] == [(2, 0.0)]
    assert L.score(make_docs([]), none, ["doc_id"]).collect() == []
