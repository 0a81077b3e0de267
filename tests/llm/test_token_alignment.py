from __future__ import annotations

import hashlib
import json
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticketflow.llm import token_alignment as A

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def both():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(f"{A.FOLDER}/{A.A_FILE}")
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=f"{A.FOLDER}/{A.B_FILE}")


PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE = {chr(b): b for b in PLAIN} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in PLAIN)}


def token_bytes_a(a, i):
    return bytes(BYTE[c] for c in a.id_to_token(i))


def token_bytes_b(b, i):
    p = b.id_to_piece(i)
    return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()


def want(both, docs):
    """The contract's rows, token by token."""
    a, b = both
    found, count = [], Counter()
    for i, text in docs:
        raw = (" " + (text or "")).encode()
        ia = a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        ib = b.encode(text) if text else []
        wa, wb = [token_bytes_a(a, x) for x in ia], [token_bytes_b(b, x) for x in ib]
        if not text or b"".join(wa) != raw or b"".join(wb) != raw:
            found.append((i, [], [], [], ""))
            continue
        ea, eb = np.cumsum([len(w) for w in wa]).tolist(), np.cumsum([len(w) for w in wb]).tolist()
        linked, j = [], 0
        for k, e in enumerate(ea):
            s = e - len(wa[k])
            while eb[j] <= s:
                j += 1
            n = j
            while n < len(eb) and eb[n] - len(wb[n]) < e:
                linked.append((ia[k], ib[n]))
                n += 1
        groups, x, y = [], 0, 0
        for e in sorted(set(ea) & set(eb)):
            k, n = ea.index(e, x) + 1, eb.index(e, y) + 1
            groups.append(",".join(map(str, ia[x:k])) + "|" + ",".join(map(str, ib[y:n])))
            x, y = k, n
        count.update(linked)
        found.append((i, ia, ib, linked, ";".join(groups)))
    top = {}
    for (_, y), c in count.items():
        top[y] = max(top.get(y, 0), c)
    return sorted([(i, len(ia), len(ib), g.count(";") + 1 if g else 0, len(li), sum(count[p] == top[p[1]] for p in li),
                    sum(count[p] for p in li), hashlib.sha256(g.encode()).hexdigest() if g else "")
                   for i, ia, ib, li, g in found], key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def got(spark, df):
    return sorted(map(tuple, df.select(COLUMNS).collect()), key=str)


@pytest.fixture
def run(spark, tmp_path):
    def run(docs):
        docs.write.parquet(f"{tmp_path}/documents.parquet")
        return got(spark, A.op13_token_alignment(spark, str(tmp_path)))
    return run


def test_query_equals_brute_force(spark, both):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(spark, A.op13_token_alignment(spark, SF)) == want(both, docs)


def test_edges(run, make_docs, both):
    texts = [None, "", " ", "a", "a  b\n\n\tc ", "▁ piece mark", "<s> </s> <unk> <0x41> <|endoftext|>", "\x00\x01\x1c\x85\xa0",
             "ünï𝄞 𝄞𝄞 日本語", "word " * 40_000, "a" * 100_000, " " * 3000, "same text", "same text", "don't we'll I'M 1234567"]
    docs = [*enumerate(texts), (None, "null id"), (12, "same text")]
    assert run(make_docs(docs)) == want(both, docs)


def test_empty_table_and_clashing_columns(run, make_docs, both):
    assert run(make_docs([]).withColumn("row", F.lit(1)).withColumn("pairs", F.lit(2)).withColumn("_text", F.lit(3))) == []


def test_clashing_columns(run, make_docs, both):
    docs = [(1, "some text"), (2, "other text")]
    assert run(make_docs(docs).selectExpr("*", "1 AS row", "2 AS pairs", "3 AS times", "4 AS n_a", "5 AS _text", "6 AS best")) \
        == want(both, docs)


def test_counts_too_many_to_send(run, make_docs, both, monkeypatch):
    monkeypatch.setattr(A, "MOST_SENT", 0)
    monkeypatch.setattr(A, "HELD", 40)
    docs = [(i, f"text number {i % 7} of many, don't ask") for i in range(60)]
    assert run(make_docs(docs)) == want(both, docs)


def test_both_libraries_give_the_same_ids(tmp_path, both):
    """A file whose ids do not follow its merges is read by the other library; here both read the same one."""
    fast = A.ByteLevel(f"{A.FOLDER}/{A.A_FILE}")
    texts = ["plain words", "<|endoftext|> is text", "  spaces \n\n and 12345 ünï𝄞", "x" * 500, "\t\x00"]
    assert fast.encode(texts) == [both[0].encode(" " + t, add_special_tokens=False).ids for t in texts]
    with open(f"{A.FOLDER}/{A.A_FILE}", encoding="utf-8") as f:
        model = json.load(f)
    vocab = model["model"]["vocab"]
    one, two = model["model"]["merges"][:2]
    join = lambda m: "".join(m.split(" ") if isinstance(m, str) else m)
    vocab[join(one)], vocab[join(two)] = vocab[join(two)], vocab[join(one)]
    path = tmp_path / "swapped.json"
    path.write_text(json.dumps(model))
    slow = A.ByteLevel(str(path))
    assert [[slow.bytes[i] for i in ids] for ids in slow.encode(texts)] == [[fast.bytes[i] for i in ids] for ids in fast.encode(texts)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=20), st.data())
def test_groups_and_links(sizes_a, data):
    total = sum(sizes_a)
    ends_a = np.cumsum(sizes_a)
    ends_b = np.array(sorted({total, *data.draw(st.lists(st.integers(1, total), max_size=20))}))
    cut_a, cut_b = A.groups(ends_a, ends_b)
    common = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    assert ends_a[cut_a - 1].tolist() == ends_b[cut_b - 1].tolist() == common
    a, b = A.links(ends_a, ends_b)
    begin_a, begin_b = [0, *ends_a[:-1]], [0, *ends_b[:-1]]
    assert list(zip(a.tolist(), b.tolist())) == [(i, j) for i in range(len(ends_a)) for j in range(len(ends_b))
                                                 if begin_a[i] < ends_b[j] and begin_b[j] < ends_a[i]]
    text = "".join(A.written(np.arange(len(ends_a)), np.arange(len(ends_b)), cut_a, cut_b, 99, 99))[:-1]
    assert text == ";".join(",".join(map(str, range(i, k))) + "|" + ",".join(map(str, range(j, n))) for i, k, j, n in
                            zip([0, *cut_a], cut_a, [0, *cut_b], cut_b))
