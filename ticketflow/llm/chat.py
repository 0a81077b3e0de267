"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string.  The
operator knows nothing of its insides: it renders the turns up to each one and
compares consecutive outputs.  Where an output begins with the one before, the
rest is the span of the new turn; where it does not, the template rewrites
history, the conversation is marked and no span of it is trusted.

Rows are dealt by conversation and sorted by turn; the task reads them as a
stream.  A template gets the whole prefix at every turn, however long the
conversation, so that its time grows with the square of a conversation's length.
Only one that its caller declares ``additive`` gets, beyond ``HEAD`` turns, the
first ``KEEP`` turns and the last ``KEEP`` for a prefix, if such prefixes located the
same spans on the turns before; at its end the conversation is rendered once as a
whole, and a template whose joined pieces are not that output fails the job.

Defined results: a null text or role is empty; equal turns of a conversation are
ordered by role and text, repeated rows are turns each; a null conversation id
is a conversation of its own; an empty table gives only the reserved
conversation of the query; columns that are not named are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# The control strings of the template below.
SYSTEM, SYSTEM_END = "<<SYS>>", "<</SYS>>"
USER, USER_END = "[INST]", "[/INST]"
OTHER, OTHER_END = "[ROLE]", "[/ROLE]"
BEGIN, END = "<s>", "</s>"

_CONTROL = re.compile(r"<</?SYS>>|\[/?INST\]|\[/?ROLE\]|</?s>")


def escape(text: str) -> str:
    """No control string is left: backslashes are doubled, and one is put after the
    first character of each control string."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def additive(template: Template) -> Template:
    """Declares that a turn's piece depends on no turns but its own and those near it."""
    template.additive = True
    return template


@additive
def instruct(turns: list[Turn]) -> str:
    """The template of the query: every turn has marks of its own."""
    out = []
    for role, text in turns:
        body = escape(text)
        if role == "user":
            out.append(f"{BEGIN}{USER} {body} {USER_END}")
        elif role == "assistant":
            out.append(f" {body} {END}")
        elif role == "system":
            out.append(f"{SYSTEM} {body} {SYSTEM_END}")
        else:
            out.append(f"{OTHER} {escape(role)} {OTHER_END} {body} {END}")
    return "".join(out)


_TURN = re.compile(
    r"<s>\[INST\] (?P<user>.*?) \[/INST\]|<<SYS>> (?P<system>.*?) <</SYS>>"
    r"|\[ROLE\] (?P<role>.*?) \[/ROLE\] (?P<other>.*?) </s>| (?P<assistant>.*?) </s>", re.S)


def read_back(piece: str) -> tuple[str, str, int, int]:
    """(role, text, start, end of the text in the piece) of one turn's span, from the marks alone."""
    m = _TURN.fullmatch(piece)
    if m is None:
        raise ValueError("not the span of one turn")
    if m["role"] is not None:
        return unescape(m["role"]), unescape(m["other"]), *m.span("other")
    kind = next(k for k in ("user", "system", "assistant") if m[k] is not None)
    return kind, unescape(m[kind]), *m.span(kind)


HEAD, KEEP = 64, 8


class Located:
    """Turns of one conversation, one after the other, each with its piece of the output."""

    def __init__(self, template: Template):
        self.template, self.turns, self.count = template, [], 0
        self.output, self.rewrites, self.short = template([]), False, getattr(template, "additive", False)
        self.all, self.joined = [], hashlib.sha256(self.output.encode("utf-8", "surrogatepass"))

    def _short(self, turns: list[Turn]) -> str | None:
        """The last turn's piece, from the first and last turns alone."""
        near = turns if len(turns) <= 2 * KEEP else turns[:KEEP] + turns[-KEEP:]
        before, after = self.template(near[:-1]), self.template(near)
        return after[len(before):] if after.startswith(before) else None

    def add(self, turn: Turn) -> str:
        """The output this turn adds ('' from the turn on at which history is rewritten)."""
        piece = self._add(turn)
        if self.short and not self.rewrites:
            self.all.append(turn)
            self.joined.update(piece.encode("utf-8", "surrogatepass"))
        else:
            self.all = []
        return piece

    def finish(self) -> None:
        """After the last turn: where prefixes were short, the whole output must be the joined pieces."""
        if self.short and not self.rewrites and self.count > HEAD and self.joined.digest() != hashlib.sha256(
                self.template(self.all).encode("utf-8", "surrogatepass")).digest():
            raise ValueError("the template is declared additive but renders a whole conversation unlike its pieces")

    def _add(self, turn: Turn) -> str:
        self.turns.append(turn)
        self.count += 1
        if self.rewrites:
            self.turns.pop()
            return ""
        if self.count > HEAD and self.short:
            if len(self.turns) > 2 * KEEP:
                self.turns = self.turns[:KEEP] + self.turns[-KEEP:]
            self.output = ""
            piece = self._short(self.turns)
            if piece is None:
                self.rewrites = True
            return piece or ""
        whole = self.template(self.turns)
        if not whole.startswith(self.output):
            self.rewrites, self.turns = True, []
            return ""
        piece, self.output = whole[len(self.output):], whole
        if 2 * KEEP < self.count <= HEAD and self._short(self.turns) != piece:
            self.short = False
        return piece


def _ordered(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    rows = conversations.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                                F.coalesce(F.col(role), F.lit("")).alias("role"),
                                F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")


def formatted(conversations: DataFrame, template: Template = instruct, conv: str = "conv_id", turn: str = "turn",
              role: str = "role", text: str = "text") -> DataFrame:
    """One row for each turn: conv, n (0, 1, ...), role, start, end (its span of the conversation's
    output), piece (that span), rewrites (history was rewritten at or before this turn).
    The output of a conversation is its pieces in order."""
    src = _ordered(conversations, conv, turn, role, text)
    schema = T.StructType([src.schema["conv"], *[T.StructField(c, k) for c, k in (
        ("n", T.LongType()), ("role", T.StringType()), ("start", T.LongType()), ("end", T.LongType()),
        ("piece", T.StringType()), ("rewrites", T.BooleanType()))]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, state, at = object(), None, 0
        for b in batches:
            rows = []
            for c, r, t in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if c != conv_id:
                    if state is not None:
                        state.finish()
                    conv_id, state, at = c, Located(template), 0
                piece = state.add((r, t))
                rows.append((state.count - 1, r, at, at + len(piece), piece, state.rewrites))
                at += len(piece)
            cols = list(zip(*rows)) if rows else [()] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, cols, kinds)], schema.names)
        if state is not None:
            state.finish()

    return src.mapInArrow(work, schema)


def digests(conversations: DataFrame, template: Template = instruct,
            reader: Callable[[str], tuple[str, str, int, int]] = read_back, **cols: str) -> DataFrame:
    """What a reader of the formatted conversations gets back: one row each.

    The loss mask covers the texts of assistant turns.  Sums and digests are
    kept up turn by turn, no conversation is held whole.
    """
    src = formatted(conversations, template, **cols)
    schema = T.StructType([T.StructField("conv_id", src.schema["conv"].dataType), *[T.StructField(c, k) for c, k in (
        ("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()),
        ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType()), ("rewrites", T.BooleanType()))]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        now, done = None, []

        def close():
            if now is not None:
                done.append((now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5], now[6]))

        def flush():
            out = pa.RecordBatch.from_pylist([dict(zip(schema.names, d)) for d in done], to_arrow_schema(schema))
            done.clear()
            return out

        for b in batches:
            for c, piece, rewrites, n in zip(*(b.column(i).to_pylist() for i in (0, 5, 6, 1))):
                if n == 0:
                    close()
                    now = [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, False]
                now[1] += 1
                now[5] += len(piece)
                now[6] |= rewrites
                if rewrites:
                    continue
                role, text, _, _ = reader(piece)
                now[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if role == "assistant":
                    now[3] += len(text)
                    now[4].update(text.encode("utf-8", "surrogatepass"))
            if len(done) >= 5000:
                yield flush()
        close()
        yield flush()

    return src.mapInArrow(work, schema)


#: Conversation -7 of the query: texts that are control strings themselves.
RESERVED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(RESERVED, "conv_id long, turn long, role string, text string")
    return digests(rows.unionByName(extra)).drop("rewrites")


QUERIES = {"op9_chat_format": op9_chat_format}

ORACLE_SQL = {"op9_chat_format": r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
           + len(regexp_extract_all(text, '<</?SYS>>|\[/?INST\]|\[/?ROLE\]|</?s>')) AS body,
           length(role) + length(role) - length(replace(role, '\', ''))
           + len(regexp_extract_all(role, '<</?SYS>>|\[/?INST\]|\[/?ROLE\]|</?s>')) AS named
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
           AS loss_sha256,
       CAST(sum(body + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 6 WHEN 'system' THEN 17
                                 ELSE 22 + named END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""}
