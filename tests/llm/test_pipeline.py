"""The whole pipeline on made tables: clashing columns, odd rows, and what each stage must leave or take."""

from __future__ import annotations

import random

import pytest

pipeline = pytest.importorskip("corpus_pipeline")

LETTERS = {"aa": "abcdefg hij", "bb": "klmnopq rst"}


def words(rnd, lang, n):
    return " ".join("".join(rnd.choice(LETTERS[lang].replace(" ", "")) for _ in range(rnd.randrange(3, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def table():
    rnd = random.Random(2)
    item = "the benchmark question asks how many moons the planet with rings has and why"
    rows = [(i, words(rnd, lang, 60), lang, f"s{i % 3}") for i in range(120) for lang in [("aa", "bb")[i % 2]]]
    rows += [(200, None, "aa", "s0"), (201, "", "aa", None), (202, "12 34 !!", None, "s1"), (203, rows[0][1], "aa", "s2"),
             (203, rows[0][1], "aa", "s2"), (204, words(rnd, "aa", 30) + " " + item + " " + words(rnd, "aa", 30), "aa", "s1"),
             (205, words(rnd, "bb", 3000), None, "s1"), (None, words(rnd, "aa", 50), "aa", "s0"),
             (206, words(rnd, "aa", 40) + " password=hU7kQ2zR9wLmX4vB8nTt " + words(rnd, "aa", 40), "aa", "s0")]
    return rows, item


def run(spark, folder, rows, item, extra=()):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows], schema)
    docs.selectExpr("*", *extra).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return pipeline.run(spark, str(folder))


EXTRA = ("doc_id * 2 AS score", "'x' AS lang_pred", "1 AS _row", "2 AS _spans", "3 AS _content", "4 AS _text", "5 AS weight",
         "6 AS probability", "7 AS _tokens", "8 AS component_id", "9 AS fingerprint", "10 AS copies", "'k' AS `odd.name`")


def test_stages_and_clashing_columns(spark, tmp_path, table):
    plain = run(spark, tmp_path / "plain", *table).collect()
    ids = {r.doc_id for r in plain}
    assert not ids & {200, 201, 202, 204}             # no letters, or a benchmark item
    assert not {0, 203} <= ids                        # copies: at most the one with the smallest id
    for r in plain:
        assert "hU7kQ2zR9wLmX4vB8nTt" not in r.text and r.lang in ("aa", "bb") and r.n_chars == len(r.text)
    assert len(ids) > 60
    got = run(spark, tmp_path / "extra", *table, EXTRA)
    rows = got.collect()
    base = ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(map(str, (tuple(r[c] for c in base) for r in rows))) == sorted(map(str, (tuple(r[c] for c in base) for r in plain)))
    assert {(r["lang_pred"], r["_row"], r["weight"], r["odd.name"]) for r in rows} == {("x", 1, 5, "k")}
    assert all(r["score"] == (None if r.doc_id is None else 2 * r.doc_id) for r in rows)


def test_empty_table(spark, tmp_path, table):
    assert run(spark, tmp_path, [], table[1]).collect() == []


def test_repeated_rows_and_ties(spark, tmp_path, table):
    rows, item = table
    got = run(spark, tmp_path, rows[:100] * 3, item).collect()
    assert {r.text for r in got} <= {r[1] for r in rows[:100]} and len({r.doc_id for r in got}) > 30
