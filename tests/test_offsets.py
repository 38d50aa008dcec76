"""Offset ranges against plain Python, over block borders and with a hot partition."""

import random

import pytest

from loadlens.sources import offsets

SCHEMA = "topic string, partition int, offset long, value string"


def ranges(values):
    out = []
    for v in sorted(values):
        if out and v == out[-1][1] + 1:
            out[-1][1] = v
        else:
            out.append([v, v])
    return [tuple(r) for r in out]


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_ranges(spark, monkeypatch, block):
    monkeypatch.setattr(offsets, "BLOCK", block)
    rng = random.Random(3)
    sent = {}
    for place in [("a", 0), ("a", 1), ("b", 0), (None, 0)]:
        n = 600 if place == ("a", 0) else 40
        sent[place] = [o for o in range(5, n) if rng.random() > 0.1 for _ in range(1 + (rng.random() < 0.1))]
    data = [(*p, o, "x") for p, found in sent.items() for o in found] + [("a", 0, None, "y")]
    rng.shuffle(data)
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    read = offsets.read_ranges(df)
    assert sorted(map(tuple, read.collect()), key=str) == sorted(
        ((*p, *r) for p, found in sent.items() for r in ranges(set(found))), key=str
    )
    twice = {p: {o for o in found if found.count(o) == 2} for p, found in sent.items()}
    assert sorted(map(tuple, offsets.repeated_ranges(df).collect()), key=str) == sorted(
        ((*p, *r, 2) for p, found in twice.items() for r in ranges(found)), key=str
    )
    inner = {p: set(range(min(f), max(f))) - set(f) for p, f in sent.items()}
    missing = offsets.missing_ranges(read)
    assert sorted(map(tuple, missing.collect()), key=str) == sorted(
        ((*p, *r) for p, found in inner.items() for r in ranges(found)), key=str
    )
    resume = {tuple(r)[:2]: r.next for r in offsets.resume_offsets(read, missing).collect()}
    assert resume == {p: min(inner[p], default=max(f) + 1) for p, f in sent.items()}


def test_expected_ends_and_partitions_without_messages(spark):
    df = spark.createDataFrame([("t", 0, o, "x") for o in (2, 3, 6)], SCHEMA)
    expected = spark.createDataFrame([("t", 0, 0, 10), ("t", 1, 5, 8), ("t", 2, 4, 4)], "topic string, partition int, start long, end long")
    read = offsets.read_ranges(df)
    missing = offsets.missing_ranges(read, expected)
    assert sorted(map(tuple, missing.collect())) == [("t", 0, 0, 1), ("t", 0, 4, 5), ("t", 0, 7, 9), ("t", 1, 5, 7)]
    resume = offsets.resume_offsets(read, missing)
    assert offsets.starting_offsets(resume) == '{"t":{"0":0,"1":5}}'
    later = spark.createDataFrame([("t", 0, 1, "x"), ("t", 1, 4, "x"), ("t", 1, 5, "x"), ("t", 3, 0, "x")], SCHEMA)
    assert sorted(r[1:3] for r in offsets.beyond(later, resume).collect()) == [(0, 1), (1, 5), (3, 0)]
    assert offsets.read_ranges(df.limit(0)).collect() == []


def test_reading_on_closes_the_gaps(spark):
    first = spark.createDataFrame([("t", 0, o, "x") for o in (0, 1, 4, 5)], SCHEMA)
    read = offsets.read_ranges(first)
    resume = offsets.resume_offsets(read, offsets.missing_ranges(read))
    every = spark.createDataFrame([("t", 0, o, "x") for o in range(9)], SCHEMA)
    both = first.unionByName(offsets.beyond(every, resume))
    assert [tuple(r) for r in offsets.read_ranges(both).collect()] == [("t", 0, 0, 8)]
    assert [tuple(r)[2:] for r in offsets.repeated_ranges(both).collect()] == [(4, 5, 2)]
