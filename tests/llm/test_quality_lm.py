from __future__ import annotations

import math

import pytest

from ticketflow.llm import quality_lm as Q

from .conftest import crc
from .test_ngram_lm import brute

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("most", [Q.MOST_SENT, 5])
def test_perplexity_equals_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(Q, "MOST_SENT", most)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    trusted = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality == 1 and not r.toxic}
    want = brute(rows, [i for i, (d, _) in enumerate(rows) if d in trusted and crc(d, 5) != 2])
    want = {rows[i][0]: v for i, v in want.items()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 and toxic = 0")
    got = Q.classify(spark.read.parquet(f"{SF}/documents.parquet"), labels).collect()
    assert len(got) == len(rows)
    cal = []
    for r in got:
        n, *_, score = want[r.doc_id]
        assert r.n_tokens == n and r.log10_prob == pytest.approx(score, rel=1e-9)
        assert r.perplexity == pytest.approx(10 ** (-score / n), rel=1e-6)
        if r.doc_id in trusted and crc(r.doc_id, 5) == 2:
            cal.append(math.floor(-score / n * 1000))
    cal.sort()  # too few for languages of their own: one quantile of all
    edge = (cal[math.ceil(Q.QUANTILE * len(cal)) - 1] + 1) / 1000
    for r in got:
        assert r.threshold == pytest.approx(10**edge) and r.kept == (r.perplexity <= r.threshold)


def test_languages_edges_and_junk(spark, make_docs):
    def text(i, words):
        return " ".join(words[(i * 7 + j * (1 + i % 5)) % len(words)] for j in range(60))
    en, de = [f"the{i}" for i in range(30)], [f"der{i}" for i in range(30)]
    rows = [(i, text(i, en), "en") for i in range(400)] + [(1000 + i, text(i, de), "de") for i in range(400)]
    rows += [(2000 + i, " ".join(f"junk{i}q{j}" for j in range(60)), ("en", "de")[i % 2]) for i in range(10)]
    rows += [(3000, None, "en"), (3001, "", None), (None, text(3, en), "en"), (5, text(5, en), "en"),
             (3002, "x " * 400_000, "fr")]
    docs = make_docs(rows)
    ids = spark.createDataFrame([(r[0],) for r in rows if r[0] is not None and r[0] < 2000] + [(None,), (5,)], "doc_id long")
    got = Q.classify(docs, ids).collect()
    assert len(got) == len(rows)
    assert not any(r.kept for r in got if r.doc_id is not None and 2000 <= r.doc_id < 2010)
    clean = [r for r in got if r.doc_id is None or r.doc_id < 2000]
    assert sum(r.kept for r in clean) >= 0.98 * len(clean)
    assert len({r.threshold for r in got if r.lang == "en"}) == 1
    none = Q.classify(docs, ids.limit(0)).collect()
    assert len(none) == len(rows) and all(r.kept and r.threshold is None for r in none)
    assert Q.classify(make_docs([]), ids).collect() == []


def test_a_quantile_of_its_own_needs_texts_above_it(spark):
    rows = [("few", 2.0 + i / 1000) for i in range(150)] + [("many", 1.0 + i / 1000) for i in range(600)]
    own, every = Q.thresholds(spark.createDataFrame(rows, "lang string, log double"), "lang", "log")
    assert {r._l for r in own.collect()} == {"many"} and every < 2.149
