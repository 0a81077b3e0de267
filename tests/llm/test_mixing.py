from __future__ import annotations

import re
from collections import defaultdict

import pytest

from ticketflow.llm import mixing as M

SF = "/root/testdata/sf0.01"


def brute_rake(cells, goals):
    """cells: {(s, l, t): tokens}; goals: one dict for each dimension."""
    w = {c: float(n) for c, n in cells.items()}
    for _ in range(400):
        for d in range(3):
            have = defaultdict(float)
            for c, x in w.items():
                have[c[d]] += x
            w = {c: x * goals[d][c[d]] / have[c[d]] if have[c[d]] else 0.0 for c, x in w.items()}
    return w


def brute_scale(cells, w, goal):
    lo, hi = 0.0, 1e18
    for _ in range(300):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(1, mid * w[c] / n) * n for c, n in cells.items() if n) < goal else (lo, mid)
    return lo


def tempered(cells, d):
    n = defaultdict(float)
    for c, x in cells.items():
        n[c[d]] += x
    raw = {k: v**M.TEMPER for k, v in n.items() if v}
    return {k: raw.get(k, 0.0) / sum(raw.values()) for k in n}


def test_query_meets_the_marginals(spark):
    out = M.op10_mixing(spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(out) == len(docs)
    cells = defaultdict(int)
    for r in out:
        assert r.tokens == len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text))
        assert (r.source, r.lang) == (docs[r.doc_id].source, docs[r.doc_id].lang)
        cells[r.source, r.lang, r.topic] += r.tokens
    goals = [tempered(cells, d) for d in range(3)]
    w = brute_rake(cells, goals)
    scale = brute_scale(cells, w, M.BUDGET * sum(cells.values()))
    for d, name in enumerate(("source", "lang", "topic")):
        have = defaultdict(float)
        for r in out:
            have[r[name]] += r.weight
        for k, v in goals[d].items():
            assert have[k] == pytest.approx(v, rel=1e-3)
    for r in out:
        c = (r.source, r.lang, r.topic)
        assert r.probability == pytest.approx(min(1, scale * w[c] / cells[c]), rel=2e-3)
    drawn = sum(r.tokens for r in out if r.kept)
    assert 0.4 < drawn / sum(cells.values()) < 0.6
    assert sum(r.probability * r.tokens for r in out) == pytest.approx(M.BUDGET * sum(cells.values()), rel=1e-3)


def test_given_targets_and_edges(make_docs):
    rows = [(i, f"w{i} and more words " * (1 + i % 5), ("en", "de")[i % 2], f"s{i % 3}") for i in range(90)]
    rows += [(100, None, "en", "s0"), (101, "", None, None), (102, None, None, None), (None, "x y", "en", None),
             (3, rows[3][1], "de", "s0"), (104, "a " * 300_000, "de", "s1")]
    docs = make_docs(rows)
    out = M.mixed(docs, targets={"lang": {"en": 3, "de": 1, "xx": 4}, "source": {"s0": 1, "s1": 1, "s2": 2, "": 0.0},
                                  "topic": {"note": 0.9, "long": 0.1}},
                  budget=0.2).collect()
    assert len(out) == len(rows)
    share = defaultdict(float)
    for r in out:
        share[r._lang] += r.weight
        share[r._source] += r.weight
        assert 0 <= r.probability <= 1
    assert share["en"] == pytest.approx(0.75, abs=0.01) and share["s2"] == pytest.approx(0.5, abs=0.01)
    assert all(r.weight == 0 and not r.kept for r in out if r.doc_id in (101, 102) or r._source == "")
    picks = defaultdict(set)
    for r in out:
        picks[r.doc_id, r._source, r._lang, r._topic].add(r.kept)
    assert all(len(v) == 1 for v in picks.values())


def test_sample_and_empty(spark, make_docs):
    from pyspark.sql import functions as F
    docs = make_docs([(i, f"some words {i}", "en", "s") for i in range(50)]).withColumn("kept", F.lit("mine")).withColumn(
        "_source", F.lit(1)).withColumn("weight", F.lit("own"))
    got = M.sample(docs, budget=1.0)
    assert got.columns == [*docs.columns, "probability"]
    assert sorted(r.doc_id for r in got.collect()) == list(range(50))
    assert M.mixed(make_docs([])).collect() == [] and M.sample(make_docs([])).collect() == []


def test_expected_and_drawn_tokens_meet_the_marginals_where_cells_are_scarce(spark):
    out = M.op10_mixing(spark, SF).collect()
    cells = defaultdict(int)
    for r in out:
        cells[r.source, r.lang, r.topic] += r.tokens
    budget = M.BUDGET * sum(cells.values())
    assert any(r.copies_expected > 1 for r in out)
    assert sum(r.copies_expected * r.tokens for r in out) == pytest.approx(budget, rel=1e-6)
    for d, name in enumerate(("source", "lang", "topic")):
        have = defaultdict(float)
        for r in out:
            have[r[name]] += r.copies_expected * r.tokens / budget
        for k, v in tempered(cells, d).items():
            assert have[k] == pytest.approx(v, rel=1e-3)
    assert all(r.copies - r.copies_expected < 1 and r.copies_expected - r.copies < 1 for r in out)


def test_sample_repeats_scarce_rows(make_docs):
    rows = [(i, "one two three four", "en", "big") for i in range(90)] + [(100 + i, "a b c d", "en", "few") for i in range(10)]
    got = M.sample(make_docs(rows), targets={"source": {"big": 1, "few": 1}}, budget=0.5).collect()
    few = [r for r in got if r.source == "few"]
    assert 20 <= len(few) <= 30 and {r.doc_id for r in few} == set(range(100, 110))
    assert sorted({round(r.probability, 6) for r in few}) == [0.5, 1.0]


def test_targets_that_cannot_be_met_are_warned_of(make_docs):
    docs = make_docs([(i, "some words here", ("en", "de")[i % 2], f"s{i % 2}") for i in range(20)])
    with pytest.warns(UserWarning, match="missed"):
        M.mixed(docs, targets={"source": {"s0": 9, "s1": 1}, "lang": {"en": 1, "de": 9}})
    with pytest.warns(UserWarning, match="left out"):
        M.mixed(docs, targets={"lang": {"en": 1, "xx": 1}})
