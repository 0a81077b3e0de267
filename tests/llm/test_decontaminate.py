from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from ticketflow.llm import decontaminate as D

SF = "/root/testdata/sf0.001"


def fold(t):
    return "".join(" " if c.isspace() else c.lower() if len(c.lower()) == 1 else c for c in t)


def budget(m):
    return max(min(int(m * D.RATE), m // D.Q - 1), 0)


def best(item, text):
    """Edits of the whole item to the best stretch of the text (plain dynamic program)."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, fold(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, fold(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in D.op8_decontamination(spark, SF).collect()}
    exact = {(d, i) for d, t in docs for i, x in items if x in t}
    assert exact and exact <= got
    text, item = dict(docs), dict(items)
    for d, i in got - exact:
        assert best(item[i], text[d]) <= budget(len(item[i]))
    rnd = random.Random(5)  # no near match is missed where some q-gram of the item occurs at all
    for d, i in rnd.sample([(d, i) for d in text for i in item if len(text[d]) < 1500], 60):
        if (d, i) not in got:
            assert best(item[i], text[d]) > budget(len(item[i]))


def test_edited_passages(spark, make_docs):
    rnd = random.Random(1)
    letters = "abcdefghij klmnop qrst"
    items = ["".join(rnd.choice(letters) for _ in range(n)) for n in (60, 120, 300, 9, 40)]

    def edited(t, k):
        t = list(t)
        for _ in range(k):
            p = rnd.randrange(len(t))
            t[p:p + 1] = rnd.choice([[], ["Z"], [t[p], "Z"]])
        return "".join(t)
    rows, want = [], {}
    for n in range(120):
        i = rnd.randrange(len(items))
        fill = "".join(rnd.choice(letters) for _ in range(rnd.randrange(400)))
        text = fill[:150] + edited(items[i], rnd.randrange(0, budget(len(items[i])) + 4)) + fill[150:]
        rows.append((n, text.upper() if n % 5 == 0 else text))
        want |= {(n, j): True for j, it in enumerate(items) if best(fold(it), fold(text)) <= budget(len(it))}
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = D.leaks(make_docs(rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == set(want)
    for r in got:
        assert 0 <= r.edits <= budget(r.item_chars) and best(fold(items[r.item_id]), fold(rows[r.doc_id][1])) <= r.edits


def test_edges(spark, make_docs):
    item = "the quick brown fox jumps over the lazy dog again"
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "short"), (5, "ünïcödé täxt öf sømé lêngth")],
                                  "item_id long, text string")
    long = "x y z " * 500_000
    rows = [(1, None), (2, ""), (3, item), (3, item), (4, long + item.replace(" ", "\n") + long), (None, "a " + item),
            (6, item + " " + item), (7, "ÜNÏCÖDÉ TÄXT ÖF SØMÉ LÊNGTH"), (8, "short"), (9, item[:30])]
    docs = make_docs(rows)
    got = sorted(((r.doc_id, r.item_id, r.start, r.edits) for r in D.leaks(docs, bench).collect()), key=str)
    assert got == sorted([(3, 1, 0, 0)] * 4 + [(4, 1, len(long), 0)] * 2 + [(None, 1, 2, 0)] * 2 + [(6, 1, 0, 0)] * 2
                         + [(6, 1, len(item) + 1, 0)] * 2 + [(7, 5, 0, 0)], key=str)
    kept = D.clean(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 8, 9]
    assert D.leaks(make_docs([]), bench).collect() == [] and D.leaks(docs, bench.limit(0)).collect() == []


def test_blocks_of_items(spark, make_docs, monkeypatch):
    items = [f"item number {i} with its very own words {i * 7919}" for i in range(30)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = make_docs([(i, f"before {t} after") for i, t in enumerate(items)])
    whole = sorted(map(tuple, D.leaks(docs, bench).collect()))
    monkeypatch.setattr(D, "BLOCK_CHARS", 200)
    assert sorted(map(tuple, D.leaks(docs, bench).collect())) == whole
    assert {(r[0], r[1]) for r in whole} >= {(i, i) for i in range(30)}


def test_bit_parallel_equals_the_plain_program():
    rnd = random.Random(4)
    for _ in range(300):
        item = [rnd.choice("abc") for _ in range(rnd.randrange(1, 40))]
        text = [rnd.choice("abcd") for _ in range(rnd.randrange(0, 60))]
        points = [np.array([ord(c) for c in x], np.uint32) for x in (item, text)]
        edits, end = D.bit_parallel(*points, len(item))
        assert edits == best(item, text) == best(item[::-1], text[:end][::-1])


@pytest.mark.parametrize("size, changes", [
    (16_000, ("below more", "at more", "above more", "below less", "at other", "above other")),
    (84_000, ("at other", "below less")), (200_000, ("below less",))])
def test_long_items(size, changes):
    """Edits below, at and above the budget, with characters that the item does not have, so that their number is known."""
    rng = np.random.default_rng(size)
    own = "".join(map(chr, rng.integers(97, 123, size)))
    items = D.Items([1], [own])
    most = int(items.budget[0])
    for change in changes:
        where, kind = change.split()
        n = {"below": most // 40, "at": most, "above": most + 50}[where]
        t = list(own)
        for p in np.sort(rng.choice(np.arange(100, size - 100), n, replace=False))[::-1].tolist():
            t[p:p + 1] = {"more": ["ä", t[p]], "less": [], "other": ["ä"]}[kind]
        points, _ = D.characters(*D.utf8(pa.array(["before " * 50 + "".join(t) + " after" * 50])))
        owner = item = np.zeros(1, np.int64)  # the region that begins with the copy
        edits, end = items.verify(points, np.array([0, len(points)]), owner, item, np.array([350 - most // 2]))
        assert edits[0] == n if kind != "less" else 0 < edits[0] <= n
        assert end[0] == 350 + len(t)
        if where == "below":  # few enough that the lemma's bound is met
            got = D._leaks(items, points, np.array([0, len(points)]))
            assert [g[:2] + g[3:] for g in got] == [[0, 0, edits[0]]]


def test_repeated_characters_in_bounded_memory():
    items = D.Items([1, 2], ["-" * 1000, "ab" * 400])
    text = "-" * 1_000_000 + "ab" * 100_000
    points, first = D.characters(*D.utf8(pa.array([text])))
    tracemalloc.start()
    owner, item, diagonal = items.regions(points, first)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20 and set(item.tolist()) == {0, 1}


def test_rounds_do_not_change_the_regions(monkeypatch):
    """Runs of repeated characters, counted run by run in small rounds, against every pair of places."""
    rnd = random.Random(8)
    texts = ["".join(rnd.choice(["-" * 30, "=-", "abc", "a" * 12, "word "]) for _ in range(40)) for _ in range(6)] + ["", "-" * 300]
    items = D.Items([*range(4)], ["-" * 60, "=-" * 30, "a" * 25 + "-" * 25, "abcword " * 6])
    points, first = D.characters(*D.utf8(pa.array(texts)))
    want = set()
    for t, text in enumerate(texts):
        for i in range(4):
            own, width = "".join(map(chr, items.points[items.first[i]:items.first[i + 1]])), int(items.budget[i]) + 1
            count: dict = {}
            for a in range(len(text) - D.Q + 1):
                for p in range(len(own) - D.Q + 1):
                    if text[a:a + D.Q] == own[p:p + D.Q]:
                        shift = int(items.size.max() + items.budget.max()) + 1
                        b = (a - p + shift) // width
                        for x in (b, b - 1):
                            count[x] = count.get(x, 0) + 1
            want |= {(t, i, b * width - shift) for b, c in count.items() if c >= items.bound[i]}
    for size in (300_000, 7):
        monkeypatch.setattr(D, "ROUND", size)
        assert set(zip(*(x.tolist() for x in items.regions(points, first)))) == want
    assert want
