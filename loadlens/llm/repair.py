"""Conversation structure repair: cheapest edits by weighted CYK over spans, combined bottom-up.

The repair grammar is in Chomsky normal form. Its nonterminals are pairs of states of the order of
roles: X(p, q) derives what leads from p to q. The binary rules are X(p, q) -> X(p, r) X(r, q); the
terminals of X(p, q) are the edits of one row, with insertions before and after it (see ``_CLOSURE``).
A cell of a span holds, for each nonterminal, the least (cost, audit). As every derivation of a span
is in some state at every split of it, all splits give the same cell: one split is enough, and
spans of 1, 2, 4, ... rows are combined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from loadlens.llm.common import cut
from loadlens.operators.sequence import dense_sequence

#: Rows or spans that one step combines to a span.
SPAN = 64
# Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# The order of roles: system at most once and first, then user and assistant in turn.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STEPS = {
    (_START, "s"): _SYSTEM,
    (_START, "u"): _USER,
    (_SYSTEM, "u"): _USER,
    (_USER, "a"): _ASSISTANT,
    (_ASSISTANT, "u"): _USER,
}
_ENDS = (_START, _ASSISTANT)
#: What an inserted row, or one with a new role, is in a state, and the state after it.
_FORCED = {p: (c, q) for (p, c), q in _STEPS.items() if c in "ua"}
_NAMES = {"u": "user", "a": "assistant"}


def _pairs() -> list[tuple[int, int]]:
    found = {(p, p) for p in range(4)} | {(p, q) for (p, _), q in _STEPS.items()}
    while more := {(p, r) for p, q in found for q2, r in found if q == q2} - found:
        found |= more
    return sorted(found)


_PAIRS = _pairs()
_AT = {pair: k for k, pair in enumerate(_PAIRS)}
_RULES = [[(_AT[p, r], _AT[r, q]) for r in range(4) if (p, r) in _AT and (r, q) in _AT] for p, q in _PAIRS]

Cell = list  # of (cost, audit) or None, by nonterminal


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans.

    Audits of one cell and cost are never the beginning of each other (the rest would be insertions,
    which cost), so the least parts make the least whole.
    """
    out: Cell = []
    for rules in _RULES:
        best = None
        for i, j in rules:
            a, b = left[i], right[j]
            if a is None or b is None:
                continue
            cost = a[0] + b[0]
            if best is None or cost < best[0]:
                best = (cost, a[1] + b[1])
            elif cost == best[0]:
                best = min(best, (cost, a[1] + b[1]))
        out.append(best)
    return out


def _cell(edits: dict[tuple[int, int], tuple[int, str]]) -> Cell:
    return [edits.get(pair) for pair in _PAIRS]


def _closure() -> Cell:
    """Any number of insertions."""
    one = {(p, q): (INSERT, "I") for p, (_, q) in _FORCED.items()}
    one |= {(p, p): (0, "") for p in range(4)}
    now = _cell(one)
    while (after := joined(now, now)) != now:
        now = after
    return now


_CLOSURE = _closure()


def _leaves(initial: str, unwanted: bool, truncated: bool) -> Cell:
    """The cell of a row: kept, given another role or deleted, between insertions."""
    edits: dict[tuple[int, int], tuple[int, str]] = {}
    if not unwanted:
        extra = TRUNCATED * truncated
        edits = {(p, q): (REROLE + extra, "R") for p, (_, q) in _FORCED.items()}
        edits |= {(p, q): (extra, "K") for (p, c), q in _STEPS.items() if c == initial}
    edits |= {(p, p): (DELETE, "D") for p in range(4)}
    return joined(joined(_CLOSURE, _cell(edits)), _CLOSURE)


_LEAF = {
    (c, unwanted, truncated): _leaves(c, unwanted, truncated)
    for c in "sua-"
    for unwanted in (False, True)
    for truncated in (False, True)
}


class Span(NamedTuple):
    """What is known of neighbouring rows of a conversation."""

    first: str  # role initials
    last: str
    illegal: int
    blank: int
    duplicate: int
    truncated: int
    low: int | None  # turns, and how many different ones
    high: int | None
    turns: int
    cell: Cell


def row_span(initial: str, fault: str, turn: int | None) -> Span:
    unwanted = fault in ("blank", "duplicate")
    cell = _LEAF[initial if initial in ("s", "u", "a") else "-", unwanted, fault == "truncated"]
    counts = [int(fault == kind) for kind in ("blank", "duplicate", "truncated")]
    return Span(initial, initial, 0, *counts, turn, turn, int(turn is not None), cell)


def _both(a: Span, b: Span) -> Span:
    same = a.high is not None and a.high == b.low
    return Span(
        a.first,
        b.last,
        a.illegal + b.illegal + (a.last + b.first not in ("su", "ua", "au")),
        a.blank + b.blank,
        a.duplicate + b.duplicate,
        a.truncated + b.truncated,
        b.low if a.low is None else a.low,
        a.high if b.high is None else b.high,
        a.turns + b.turns - same,
        joined(a.cell, b.cell),
    )


def combined(spans: list[Span]) -> Span:
    """Neighbouring spans as one, by twos, bottom-up."""
    while len(spans) > 1:
        spans = [_both(*spans[i : i + 2]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
    return spans[0]


def cheapest(cell: Cell) -> tuple[int, str]:
    return min(c for q in _ENDS if (c := cell[_AT[_START, q]]) is not None)


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the rows that an audit leaves, in order."""
    state = _START
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K":
            state = _STEPS[state, role[:1]]
        else:
            letter, state = _FORCED[state]
            role = _NAMES[letter]
        yield edit, role, text


_COUNTS = ["illegal", "blank", "duplicate", "truncated"]
_SPAN_TYPE = T.StructType(
    [
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in _COUNTS],
        T.StructField("low", T.LongType()),
        T.StructField("high", T.LongType()),
        T.StructField("turns", T.LongType()),
        T.StructField("costs", T.ArrayType(T.LongType())),
        T.StructField("audits", T.ArrayType(T.StringType())),
    ]
)


def _ordered_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            yield from batch.slice(at, 1024).to_pylist()


def _span_of(row: dict) -> Span:
    values = [row[f.name] for f in _SPAN_TYPE][:-2]
    cell = [None if c is None else (c, a) for c, a in zip(row["costs"], row["audits"], strict=True)]
    return Span(*values, cell)


def _combine(spans: DataFrame, read: Callable[[dict], Span]) -> DataFrame:
    """Every ``SPAN`` neighbours of a conversation as one; ``read`` makes the span of a row.

    The blocks of a long conversation are spread over all tasks; one task holds one block at a time.
    """
    schema = T.StructType([spans.schema["conv"], T.StructField("at", T.LongType()), *_SPAN_TYPE])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches):
        out = []
        for (conv, block), rows in groupby(_ordered_rows(batches), lambda r: (r["conv"], r["block"])):
            s = combined([read(r) for r in rows])
            costs = [c and c[0] for c in s.cell]
            out.append((conv, block, *s[:-1], costs, [c and c[1] for c in s.cell]))
            if len(out) == 256:
                yield _record(out, arrow)
                out = []
        if out:
            yield _record(out, arrow)

    blocks = spans.withColumn("block", F.expr(f"at div {SPAN}"))
    dealt = blocks.repartition("conv", "block").sortWithinPartitions("conv", "block", "at")
    return dealt.mapInArrow(run, schema)


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _rewrite(schema: T.StructType):
    """Rows of conversations, each led by its audit, to the repaired rows."""
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches):
        out, size = [], 0
        for conv, rows in groupby(_ordered_rows(batches), lambda r: r["conv"]):
            audit = next(rows)["audit"]
            texts = ((r["role"], r["text"]) for r in rows)
            for position, row in enumerate(edited(audit, texts), 1):
                out.append((conv, position, *row))
                size += len(row[2]) + 64
                if size > 1 << 20:
                    yield _record(out, arrow)
                    out, size = [], 0
        if out:
            yield _record(out, arrow)

    return run


class Repair(NamedTuple):
    #: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``, one row a conversation.
    report: DataFrame
    #: ``conv_id, position, edit, role, text``, the repaired rows; those of a conversation lie together in order.
    rows: DataFrame


def repair_conversations(
    conversations: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> Repair:
    """Faults of conversations and the cheapest edits after which their roles are in order.

    Rows are taken by turn, nulls first, then role and text. A row's first fault counts: blank (no
    character but blanks, tabs and line ends), duplicate (role and text seen earlier), truncated
    (its last such character is none of ``.!?``). Blank and duplicate rows must go. Kept rows cost
    nothing, a new role 1, a deletion 2, an inserted empty row 5, and a truncated row that stays 5. Role
    initials must then be an optional s and one or more ua, or there must be no row. Of edits of
    equal cost the audit (their initials K, R, D, I in order) that is least in ASCII is taken.

    Rows are numbered by a range sort, so a long conversation is spread over the tasks, and combined
    ``SPAN`` by ``SPAN``: two steps reach 4,096 rows, five a thousand million. Only the rewriting
    of a conversation is in sequence; it holds the audit and one row at a time.

    Null roles and texts count as one blank. Null conversation ids are one conversation. Repeated
    rows are duplicates. An empty table gives empty tables; other columns are not read.
    """
    blank = F.lit(" ")
    rows = conversations.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), blank).alias("role"),
        F.coalesce(F.col(text_col), blank).alias("text"),
    )
    placed = cut(dense_sequence(rows, ["turn", "role", "text"], by=["conv"], start=0, name="at"))
    same = ["conv", "role", F.sha2("text", 256).alias("digest")]
    firsts = placed.groupBy(*same).agg(F.min("at").alias("at"))
    firsts = firsts.select(F.col("conv").alias("c"), F.col("at").alias("a"), F.lit(True).alias("new"))
    known = placed.join(firsts, placed["conv"].eqNullSafe(F.col("c")) & (F.col("at") == F.col("a")), "left")
    ending = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    fault = (
        F.when(ending == "", "blank")
        .when(F.col("new").isNull(), "duplicate")
        .when(~F.right(ending, F.lit(1)).isin(*".!?"), "truncated")
        .otherwise("")
    )
    leaves = known.select(
        "conv",
        "at",
        F.col("turn").cast("long").alias("turn"),
        F.left("role", F.lit(1)).alias("initial"),
        fault.alias("fault"),
    )
    spans = cut(_combine(leaves, lambda r: row_span(r["initial"], r["fault"], r["turn"])))
    while spans.agg(F.coalesce(F.max("at"), F.lit(0))).first()[0]:
        spans = cut(_combine(spans, _span_of))

    found = F.array_compact(
        F.transform(
            F.array(*[F.lit(_AT[_START, q]) for q in _ENDS]),
            lambda k: F.when(
                F.get("costs", k).isNotNull(),
                F.struct(F.get("costs", k).alias("cost"), F.get("audits", k).alias("audit")),
            ),
        )
    )
    best = spans.withColumn("best", F.array_min(found))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    counts = ["blank", "duplicate", "truncated", "illegal"]
    report = cut(best.select(F.col("conv").alias("conv_id"), gaps.alias("gaps"), *counts, "best.*"))

    heads = report.select(F.col("conv_id").alias("conv"), F.lit(-1).cast("long").alias("at"), "audit")
    every = heads.unionByName(placed.select("conv", "at", "role", "text"), allowMissingColumns=True)
    schema = T.StructType(
        [
            T.StructField("conv_id", rows.schema["conv"].dataType),
            T.StructField("position", T.LongType()),
            T.StructField("edit", T.StringType()),
            T.StructField("role", T.StringType()),
            T.StructField("text", T.StringType()),
        ]
    )
    dealt = every.repartition("conv").sortWithinPartitions("conv", "at")
    return Repair(report, dealt.mapInArrow(_rewrite(schema), schema))


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id, sha256`` of the repaired rows as ``role:text``, joined by line ends.

    The digest is made row by row as they come, so no conversation is held as a whole.
    """
    schema = T.StructType([rows.schema["conv_id"], T.StructField("sha256", T.StringType())])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches):
        out = []
        for conv, own in groupby(_ordered_rows(batches), lambda r: r["conv_id"]):
            digest = hashlib.sha256()
            for n, r in enumerate(own):
                digest.update(f"{chr(10) * (n > 0)}{r['role']}:{r['text']}".encode())
            out.append((conv, digest.hexdigest()))
            if len(out) == 1024:
                yield _record(out, arrow)
                out = []
        if out:
            yield _record(out, arrow)

    return rows.select("conv_id", "role", "text").mapInArrow(run, schema)


def damaged(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn"
) -> DataFrame:
    """``conv_id, turn, role, text`` with the faults that the CRC of conversation and turn chooses.

    Remainders of 20: 0 drops a row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4
    makes it the user's. Nulls count as one blank.
    """
    spelled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col)]
    kind: Column = F.crc32(F.concat(spelled[0], F.lit(":"), spelled[1])) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    made = conversations.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    )
    return made.drop("copy")
