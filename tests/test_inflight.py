"""Requests in flight as a stream against the same figures in plain Python, over restarts too."""

import random
from datetime import timedelta

import pytest

from loadlens.streaming import answers, inflight, sinks
from loadlens.streaming import requests as sreq
from tests.helpers import MOMENT

SCHEMA = "device string, request_id string, kind string, at timestamp"
START = MOMENT.replace(minute=0, second=0, microsecond=0)
TIMEOUT, TICK = 600, 300


def us(moment):
    return round((moment - MOMENT.replace(year=1970, month=1, day=1, hour=0, minute=0, second=0, microsecond=0)) / timedelta(microseconds=1))


def made(n=120):
    """Requests of two devices, one hot; some answered late, twice or never, and answers to nothing."""
    rng = random.Random(4)
    sent = {}
    for i in range(n):
        sent[f"r{i}"] = ("a" if i % 4 else "b", START + timedelta(seconds=30 * i + rng.random()))
    events = [(d, r, "sent", t) for r, (d, t) in sent.items()]
    for i, (r, (d, t)) in enumerate(sent.items()):
        if i % 5:
            events.append((d, r, "answered", t + timedelta(seconds=[5, 400, 599, 900][i % 4])))
        if i % 11 == 1:
            events.append((d, r, "answered", t + timedelta(seconds=950)))
    events.append(("a", "unknown", "answered", START + timedelta(seconds=400)))
    return sent, events


def expected(sent, events, mark):
    done = {}
    for _, r, kind, t in events:
        if kind == "answered":
            done[r] = min(t, done.get(r, t))
    ends, levels = [], {}
    for r, (device, t) in sent.items():
        limit = t + timedelta(seconds=TIMEOUT)
        answered = r in done and done[r] <= limit
        end = done[r] if answered else limit
        tick = -(-us(end) // (TICK * 10**6)) * TICK * 10**6
        if tick <= mark:
            ends.append((device, r, us(t), us(end), "answered" if answered else "timeout"))
        first = -(-us(t) // (TICK * 10**6)) * TICK * 10**6
        for k in range(first, us(end), TICK * 10**6):
            if k <= mark:
                levels[device, k] = levels.get((device, k), 0) + 1
    return sorted(ends), sorted((*k, n) for k, n in levels.items())


def add(spark, folder, events, name):
    spark.createDataFrame(events, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def drain(spark, folder, place):
    sreq.prepare_session(spark)
    events = sreq.stream_parquet(spark, f"{folder}/*", spark.createDataFrame([], SCHEMA).schema, max_files=1)
    tracked = inflight.track_requests(events, TIMEOUT, TICK, "2 minutes", buckets=3)
    sinks.to_parquet(tracked, f"{place}/table", f"{place}/progress").awaitTermination()
    return spark.read.schema(tracked.schema).parquet(f"{place}/table")


def test_stream_equals_batch_after_restarts(spark, tmp_path):
    sent, events = made()
    events.sort(key=lambda e: e[3])
    folder, place = str(tmp_path / "in"), str(tmp_path / "out")
    rng = random.Random(1)
    for k in range(4):  # a start for every quarter; rows within it in any order
        part = events[len(events) * k // 4 : len(events) * (k + 1) // 4]
        rng.shuffle(part)
        add(spark, folder, part, f"part{k}")
        found = drain(spark, folder, place)
    mark = us(max(e[3] for e in events)) - 120 * 10**6
    ends, levels = expected(sent, events, mark // 1000 * 1000)
    assert sorted(map(tuple, inflight.ended(found).collect())) == ends
    assert sorted(map(tuple, inflight.levels(found).collect())) == levels
    assert {e[4] for e in ends} == {"answered", "timeout"} and max(n for *_, n in levels) > 5


def test_state_needs_the_prepared_session(spark, tmp_path):
    folder = str(tmp_path / "in")
    add(spark, folder, made(3)[1], "p")
    events = sreq.stream_parquet(spark, f"{folder}/*", spark.createDataFrame([], SCHEMA).schema)
    old = {k: spark.conf.get(k, None) for k in sreq.STREAM_OPTIONS}
    try:
        for k in old:
            spark.conf.unset(k)
        with pytest.raises(RuntimeError):
            inflight.track_requests(events, TIMEOUT, TICK)
    finally:
        sreq.prepare_session(spark)


def test_answers_in_time_late_and_missing(spark, tmp_path):
    sreq.prepare_session(spark)
    sent, events = made(60)
    events.sort(key=lambda e: e[3])
    for k in range(3):
        part = events[len(events) * k // 3 : len(events) * (k + 1) // 3]
        add(spark, str(tmp_path / "in"), part, f"p{k}")
    schema = spark.createDataFrame([], SCHEMA).schema

    def side(kind, name):
        live = sreq.stream_parquet(spark, f"{tmp_path}/in/*", schema, max_files=1).filter(f"kind = '{kind}'")
        return live.select("request_id", live["at"].alias(name), "device")

    joined = answers.match_answers(side("sent", "t"), side("answered", "u"), "10 MINUTES", "t", "u")
    assert "device_answer" in joined.columns
    found = {}
    for r in sinks.run_to_table(joined, "answers").collect():
        found.setdefault(r.request_id, []).append(r.u)
    mark = min(max(t for _, t in sent.values()), max(e[3] for e in events if e[2] == "answered"))
    mark -= timedelta(minutes=10)
    for r, (_, t) in sent.items():
        times = sorted(e[3] for e in events if e[1] == r and e[2] == "answered" and e[3] <= t + timedelta(minutes=10))
        if times:
            assert sorted(found[r]) == times
        elif t + timedelta(minutes=10) < mark:
            assert found[r] == [None]
        else:
            assert r not in found
    assert any(v == [None] for v in found.values())
