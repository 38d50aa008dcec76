"""Conversation repair against a search through all edits."""

import hashlib
import heapq
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loadlens.llm import repair
from loadlens.llm.repair import damaged, digests, repair_conversations

SCHEMA = "conv_id long, turn long, role string, text string, at int, cell string"
BLANK = " \t\n\x0b\x0c\r"


def faults(rows):
    """Rows in order, each with its first fault."""
    seen, out = set(), []
    for turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        kind = ""
        if not text.strip(BLANK):
            kind = "blank"
        elif (role, text) in seen:
            kind = "duplicate"
        elif text.rstrip(BLANK)[-1] not in ".!?":
            kind = "truncated"
        seen.add((role, text))
        out.append((turn, role, text, kind))
    return out


def search(rows):
    """The least (cost, audit, roles and texts): Dijkstra over rows done and roles so far."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, roles, out = heapq.heappop(heap)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, out
        state = (at, roles[-1:], roles[:1] == "s", len(roles) > 0)
        if state in done:
            continue
        done.add(state)
        todo = []
        if at < len(rows):
            _, role, text, kind = rows[at]
            todo.append((2, "D", 1, None, None))
            if kind not in ("blank", "duplicate"):
                extra = 5 * (kind == "truncated")
                todo.append((extra, "K", 1, role, text))
                todo += [(extra + 1, "R", 1, new, text) for new in ("user", "assistant")]
        todo += [(5, "I", 0, new, "") for new in ("user", "assistant")]
        for more, edit, step, role, text in todo:
            now = roles + (role[:1] or "-") if role is not None else roles
            if re.fullmatch("s?(ua)*u?", now):
                row = () if role is None else ((role, text),)
                heapq.heappush(heap, (cost + more, audit + edit, at + step, now, out + row))
    raise AssertionError


def expected(rows):
    found = faults(rows)
    cost, audit, out = search(found)
    kinds = [k for *_, k in found]
    turns = {t for t, *_ in found if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [r[:1] for _, r, *_ in found]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit), list(out)


ROLE = st.sampled_from(["system", "user", "assistant", "tool", ""])
TEXT = st.sampled_from(["Yes.", "No!", "Why?", "and then", "", " \n", "More."])
ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 9)), ROLE, TEXT), min_size=1, max_size=9)


@settings(deadline=None, max_examples=300)
@given(ROWS)
def test_cells_give_what_a_search_gives(rows):
    found = faults(rows)
    span = repair.combined([repair.row_span(r[:1], kind, t) for t, r, _, kind in found])
    (gaps, blank, duplicate, truncated, illegal, cost, audit), out = expected(rows)
    assert repair.cheapest(span.cell) == (cost, audit)
    assert (span.blank, span.duplicate, span.truncated, span.illegal) == (blank, duplicate, truncated, illegal)
    assert (0 if span.low is None else span.high - span.low + 1 - span.turns) == gaps
    kept = iter([(r, t) for _, r, t, _ in found])
    assert [(r, t) for _, r, t in repair.edited(audit, kept)] == out


@settings(deadline=None, max_examples=100)
@given(ROWS, st.randoms())
def test_every_split_gives_the_same_cell(rows, random):
    spans = [repair.row_span(r[:1], kind, t) for t, r, _, kind in faults(rows)]
    whole = repair.combined(list(spans))
    while len(spans) > 1:
        at = random.randrange(len(spans) - 1)
        spans[at : at + 2] = [repair._both(*spans[at : at + 2])]
    assert spans[0] == whole


CASES = {
    1: [(0, "system", "Be kind."), (1, "user", "Hello?"), (2, "assistant", "Hello.")],
    2: [(5, "assistant", "First."), (9, "assistant", "Second.")],
    3: [(0, "user", ""), (1, "user", " "), (2, "system", "\n")],
    4: [(None, "user", "A."), (None, "user", "A."), (3, "assistant", "cut of"), (3, "tool", "B.")],
    5: [(k, ("user", "assistant")[k % 7 % 2], f"Row {k}" + "." * (k % 5 > 0)) for k in range(150)],
    None: [(0, "user", "x" * 300_000 + "."), (1, "assistant", "Done.")],
}


@pytest.mark.parametrize("span", [64, 3])
def test_table(spark, monkeypatch, span):
    monkeypatch.setattr(repair, "SPAN", span)
    rows = [(c, *r, 0, "x") for c, found in CASES.items() for r in found]
    made = repair_conversations(spark.createDataFrame(rows, SCHEMA).repartition(5))
    report = {r[0]: tuple(r)[1:] for r in made.report.collect()}
    sums = {r[0]: r[1] for r in digests(made.rows).collect()}
    kept = {}
    for r in sorted(made.rows.collect(), key=lambda r: r.position):
        kept.setdefault(r.conv_id, []).append((r.role, r.text))
    for conv, found in CASES.items():
        want, out = expected(found)
        assert report[conv] == want
        assert kept.get(conv, []) == out
        if out:
            assert sums[conv] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    assert sums.keys() == kept.keys()


def test_null_roles_and_texts_are_one_blank(spark):
    rows = [(1, 0, None, "A."), (1, 1, "assistant", None), (1, 2, "assistant", "B.")]
    made = repair_conversations(spark.createDataFrame([(*r, 0, "") for r in rows], SCHEMA))
    assert [tuple(r) for r in made.report.collect()] == [(1, 0, 1, 0, 0, 2, 3, "RDK")]


def test_damage(spark):
    rows = [(c, t, "assistant", "Well. Is it? Yes!", 0, "") for c in range(20) for t in (*range(10), None)]
    import zlib

    want = []
    for c, t, role, text, *_ in rows:
        kind = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind == 1 else "Well Is it Yes" if kind == 2 else text
        want += [(c, t, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    got = [tuple(r) for r in damaged(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table(spark):
    made = repair_conversations(spark.createDataFrame([], SCHEMA))
    assert made.report.collect() == [] and digests(made.rows).collect() == []
