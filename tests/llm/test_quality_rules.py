from __future__ import annotations

import re
from collections import Counter, defaultdict

from ticketflow.llm import quality_rules as Q

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def norm(line):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in " ".join(WORD.findall(line)))
    return re.sub("[0-9]", "0", low)


def brute(rows):
    texts = defaultdict(set)
    holders = defaultdict(set)
    for _, t, h in rows:
        t, h = t or "", h or ""
        texts[h].add(t)
        for line in t.split("\n"):
            if WORD.search(line):
                holders[h, norm(line)].add(t)
    out = []
    for d, t, h in rows:
        t, h = t or "", h or ""
        w = WORD.findall(t)
        win = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        rep = {i + j for i in range(len(w) - 2) if win[tuple(w[i:i + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
        gone = sum(len(WORD.findall(x)) for x in lines
                   if len(holders[h, norm(x)]) > max(Q.MIN_TEXTS, Q.SHARE * len(texts[h])))
        left = len(w) - gone
        out.append((d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)),
                    len(rep), failed, gone, not failed and left >= 50 and left >= Q.MIN_LEFT * len(w)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(Q.op7_quality_rules(spark, SF)) == brute(rows)


def test_edges(make_docs):
    def prose(i, n=80):
        return " ".join(f"w{'abcdefghij'[i // 100]}{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i % 10]}x"
                        f"{'abcdefghij'[j // 10]}{'abcdefghij'[j % 10]}é" for j in range(n))
    boiler = " ".join(f"Menu{i}" for i in range(70))
    rows = [(i, f"{boiler} {i}\n{prose(i)}", None, "a") for i in range(30)]
    rows += [(100 + i, f"{boiler}  {i}\n{prose(i, 10)}", None, "a") for i in range(5)]       # depleted
    rows += [(200 + i, f"{boiler} 7\n{prose(i)}", None, "b") for i in range(5)]              # rare on host b
    rows += [(300 + i, prose(999), None, "a") for i in range(60)]                            # copies of one text
    rows += [(400, None, None, "a"), (401, "", None, None), (402, " \n\x0b", None, None), (None, prose(5), None, None),
             (404, "a b c " * 100_000, None, "a"), (405, "#*$%&|<>\nüü x\n#*$%&|<>", None, None),
             (405, "#*$%&|<>\nüü x\n#*$%&|<>", None, None)]
    out = got(Q.quality(make_docs(rows)))
    assert out == brute([(r[0], r[1], r[3]) for r in rows])
    kept = {r[0] for r in out if r[-1]}
    assert kept == {*range(30), *range(200, 205), *range(300, 360), None}
    assert Q.quality(make_docs([])).collect() == []


def test_verdict_does_not_depend_on_the_size_of_the_host(make_docs):
    boiler = " ".join(f"Licence{i}" for i in range(200))
    held = [(i, f"{boiler}\n" + " ".join(f"own{chr(97 + i)}x{j}" for j in range(55)), None, "hot") for i in range(12)]
    rare = [(50 + i, " ".join(f"few{j}" for j in range(60)) + f"\nrest {i}", None, "hot") for i in range(5)]
    rest = [(100 + i, " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}{j}" for j in range(60)),
             None, "hot") for i in range(1200)]
    for rows in (held + rare, held + rare + rest):
        out = {r.doc_id: r for r in Q.quality(make_docs(rows)).collect()}
        assert all(out[i].n_removed_words == 200 and not out[i].kept for i in range(12))
        assert all(out[50 + i].n_removed_words == 0 and out[50 + i].kept for i in range(5))
    small = {r.doc_id: r for r in Q.quality(make_docs(held[:4] + rare[:1]), share=Q.SHARE).collect()}
    assert all(small[i].n_removed_words == 200 for i in range(4)) and small[50].n_removed_words == 0
