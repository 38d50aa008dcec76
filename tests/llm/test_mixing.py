"""Mixing of sources: targets, flows and documents taken, against plain Python."""

import hashlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loadlens.llm.mixing import MOST, WEIGHTS, mix_sources, route

SCHEMA = "doc_id long, text string, source string, key long, size int, pattern string, target string"


def words(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return len([w for w in (text or "").split(" ") if w])


def wanted(sizes):
    """Target of each source: excess is shared again until no source is above its most."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: WEIGHTS[k % len(WEIGHTS)] for k, s in enumerate(order)}
    full, left = {}, Fraction(sum(sizes.values()))
    while rest := [s for s in order if s not in full]:
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = [s for s in rest if share[s] >= MOST * sizes[s]]
        if not above:
            return full | share
        full |= {s: Fraction(MOST * sizes[s]) for s in above}
        left -= sum(full[s] for s in above)
    return full


def expected(rows):
    """(id, size, taken) of every row, in the order of the hash within its source."""
    sizes = Counter()
    of = defaultdict(list)
    for i, text, source in rows:
        sizes[source] += words(text)
        key = hashlib.md5(f"0:{'' if i is None else i}:{text or ''}".encode()).hexdigest()[:15]
        of[source].append((key, i, words(text)))
    out = []
    for source, target in wanted(sizes).items():
        quota = int(target + Fraction(1, 2))
        passes, rest = divmod(quota, sizes[source]) if sizes[source] else (0, 0)
        before = 0
        for _, i, n in sorted(of[source], key=lambda r: r[0]):
            out.append((i, n, n * (passes + (2 * before + n < 2 * rest))))
            before += n
    return sorted(out, key=str)


ROWS = (
    [(i, f"hot word {i} " * (i % 7 + 1), "src0") for i in range(200)]
    + [(300 + i, "some words here", f"src{i % 5 + 1}") for i in range(30)]
    + [(400, None, "src2"), (401, "", "empty"), (402, " \n", "empty"), (403, "two words", None)]
    + [(None, "the same row again", "same")] * 40
    + [(500, "repeated id", "same"), (500, "another text", "same"), (600, "w " * 20_000, "src0")]
)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], SCHEMA).repartition(parts)


@pytest.fixture(scope="module")
def mixed(spark):
    made = mix_sources(frame(spark, ROWS))
    return made.documents.collect(), made.sources.collect()


def test_documents(mixed):
    assert sorted(((r.doc_id, r["size"], r.taken) for r in mixed[0]), key=str) == expected(ROWS)


def test_targets(mixed):
    sizes = Counter()
    for _, text, source in ROWS:
        sizes[source] += words(text)
    want = wanted(sizes)
    for row in mixed[1]:
        assert row.source_size == sizes[row.source]
        assert row.target == pytest.approx(float(want[row.source]))
    taken, largest = Counter(), Counter()
    for r in mixed[0]:
        assert r.taken <= MOST * r["size"]
        taken[r.sources[0]] += r.taken
        largest[r.sources[0]] = max(largest[r.sources[0]], r["size"])
    for row in mixed[1]:
        assert abs(taken[row.source] - row.target) <= largest[row.source] / 2 + 1


def test_shares_of_overlapping_sources(spark):
    """A document of several sources serves those that want it, and rows do not depend on the split."""
    rows = [(i, "four words of text", ["a", "b"] if i % 2 else ["b", "c", "b"]) for i in range(300)]
    rows += [(1000 + i, "two words", ["c"] if i % 3 else None) for i in range(90)]
    results = []
    for parts in (1, 5):
        made = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source array<string>").repartition(parts))
        results.append(sorted(tuple(r) for r in made.documents.collect()))
        given = Counter()
        for _, sources, size, taken, shares in results[-1]:
            assert taken == size * sum(s.copies for s in shares) <= MOST * size
            assert {s.source for s in shares} <= set(sources)
            for s in shares:
                given[s.source] += size * s.copies
        for row in made.sources.collect():
            assert abs(given[row.source] - row.quota) <= 4 * 2
    assert results[0] == results[1]


def test_empty_table(spark):
    made = mix_sources(frame(spark, ROWS, 1).limit(0))
    assert made.documents.collect() == [] and made.sources.collect() == []


def cost_of(flow, capacity):
    """Of words sent by patterns, the k-th copy costing k - 1."""
    return sum(sum(k * max(0, min(c, f - k * c)) for k in range(MOST)) for f, c in zip(flow, capacity, strict=True))


@settings(deadline=None, max_examples=150)
@given(
    st.lists(st.tuples(st.integers(0, 2), st.sets(st.integers(0, 2), min_size=1)), min_size=1, max_size=3),
    st.lists(st.integers(0, 5), min_size=3, max_size=3),
)
def test_flow_is_largest_and_cheapest(patterns, quotas):
    capacity = [c for c, _ in patterns]
    members = [sorted(m) for _, m in patterns]
    quota = {s: quotas[s] for m in members for s in m}
    sent = route(capacity, members, quota, MOST)
    flow = [sum(sent[p, s] for s in members[p]) for p in range(len(members))]
    for s, q in quota.items():
        assert sum(n for (_, t), n in sent.items() if t == s) <= q
    best = None
    arcs = [(p, s) for p, m in enumerate(members) for s in m]
    for amounts in product(*[range(min(MOST * capacity[p], quota[s]) + 1) for p, s in arcs]):
        into, out = Counter(), [0] * len(members)
        for (p, s), n in zip(arcs, amounts, strict=True):
            into[s] += n
            out[p] += n
        if all(into[s] <= quota[s] for s in quota) and all(o <= MOST * c for o, c in zip(out, capacity, strict=True)):
            best = min(best or (1, 0), (-sum(out), cost_of(out, capacity)))
        if len(arcs) > 5:
            break
    if len(arcs) <= 5:
        assert (-sum(flow), cost_of(flow, capacity)) == best
