from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ticketflow.llm import chat as C

SF = "/root/testdata/sf0.01"
BITS = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "\\", "<",
                                 "/s>", "[", "INST]", " ", "\n", "a", "ü", "𝄞"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "<s>", ""]), BITS), max_size=6))
def test_round_trip(turns):
    state, at, out = C.Located(C.instruct), 0, []
    pieces = [state.add(t) for t in turns]
    assert "".join(pieces) == C.instruct(turns) and not state.rewrites
    assert [C.read_back(p)[:2] for p in pieces] == turns
    for (role, text), p in zip(turns, pieces):
        _, _, a, b = C.read_back(p)
        assert C.unescape(p[a:b]) == text


def want(rows):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t is not None, t if t is not None else 0, r or "", x or ""))
    out = []
    for c, turns in by.items():
        turns = [(r, x) for _, _, r, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        out.append((c, len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(),
                    len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(C.instruct(turns))))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert got(C.op9_chat_format(spark, SF)) == want(rows + C.RESERVED)


def test_edges(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, None, "system", ""), (2, 5, "assistant", "b"),
            (2, 5, "assistant", "a"), (2, 5, "assistant", "a"), (None, 0, "user", "n"), (None, 1, "assistant", "m"),
            (3, 0, "user", "long " * 200_000), (4, 0, "assistant", "</s>")]
    rows += [(9, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(25_000)]
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(rows, schema)
    from pyspark.sql import functions as F
    assert got(C.digests(df.withColumn("conv", F.lit(1)).withColumn("n", F.lit("z")))) == want(rows)
    assert C.digests(spark.createDataFrame([], schema)).collect() == []


def numbered(turns):
    """Needs the whole history: every turn has its number."""
    return "".join(f"<{i}:{r}>{t}" for i, (r, t) in enumerate(turns))


def test_rewriting_templates_are_detected(spark):
    def without_thoughts(turns):
        """Drops the text of assistant turns once another turn follows."""
        return "".join(f"<{r}>{'' if r == 'assistant' and i + 1 < len(turns) else t}" for i, (r, t) in enumerate(turns))

    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (2, 0, "user", "a"),
                                (2, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    out = sorted((r.conv, r.n, r.piece, r.rewrites) for r in C.formatted(df, without_thoughts).collect())
    assert out == [(1, 0, "<user>a", False), (1, 1, "<assistant>b", False), (1, 2, "", True), (2, 0, "<user>a", False),
                   (2, 1, "<assistant>b", False)]


@pytest.mark.parametrize("template", [numbered, C.instruct])
def test_long_conversations(template):
    turns = [(("user", "assistant")[i % 2], f"t{i}") for i in range(300)]
    state = C.Located(template)
    assert "".join(state.add(t) for t in turns) == template(turns)
    assert state.short == (template is C.instruct) and (len(state.turns) <= 2 * C.KEEP) == state.short


def keeps_hundred():
    def last_hundred(turns):
        """Rewrites history from turn 101 on."""
        return "".join(f"<{r}>{t}" for r, t in turns[-100:])
    return last_hundred


def test_templates_that_rewrite_late_are_detected(spark):
    last_hundred = keeps_hundred()
    turns = [(("user", "assistant")[i % 2], f"t{i}") for i in range(150)]
    state = C.Located(last_hundred)
    pieces = [state.add(t) for t in turns]
    assert "".join(pieces[:100]) == last_hundred(turns[:100]) and state.rewrites and pieces[100:] == [""] * 50
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)],
                               "conv_id long, turn long, role string, text string")
    out = {r.n: r.rewrites for r in C.formatted(df, last_hundred).collect()}
    assert out == {i: i >= 100 for i in range(150)}


def test_a_wrong_declaration_fails():
    for template, wrong in ((C.additive(keeps_hundred()), True), (C.instruct, False)):
        state = C.Located(template)
        for i in range(150):
            state.add(("user", f"t{i}"))
        assert state.short
        if wrong:
            with pytest.raises(ValueError, match="declared additive"):
                state.finish()
        else:
            state.finish()
