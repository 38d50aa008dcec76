"""The reduced timeline draws what all rows draw; merged states keep their bound."""

import math
import random
from datetime import timedelta

from pyspark.sql import functions as F

from loadlens.operators import sketches, timeline
from tests.helpers import MOMENT

SCHEMA = "run_label string, timestamp timestamp, inference_time_ms double"


def test_corners_of_every_pixel(spark):
    rng = random.Random(8)
    data = [("hot", MOMENT + timedelta(milliseconds=rng.randrange(60_000)), rng.gauss(50, 20)) for _ in range(5000)]
    data += [("few", MOMENT + timedelta(seconds=s), v) for s, v in [(0, 1.0), (0, 9.0), (5, -0.0), (5, 0.0), (9, math.inf)]]
    data += [("one", MOMENT, 3.0), ("one", MOMENT, 7.0), ("odd", None, 1.0), ("odd", MOMENT, None)]
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = {}
    for r in timeline.plot_points(df, width=16).collect():
        got.setdefault((r.run_label, r.pixel), {})[r.point] = (round(r.elapsed_sec, 6), r.inference_time_ms)
    want = {}
    for run in ("hot", "few", "one"):
        rows = [((t - MOMENT) / timedelta(seconds=1), v) for name, t, v in data if name == run]
        start = min(x for x, _ in rows)
        rows = [(round(x - start, 6), v) for x, v in rows]
        span = max(x for x, _ in rows)
        for x, v in rows:
            pixel = min(15, int(round(x * 1e6) * 16 // round(span * 1e6))) if span else 0
            want.setdefault((run, pixel), []).append((x, v))
    assert set(got) == set(want)
    for key, rows in want.items():
        up = sorted(rows, key=lambda r: (r[1], r[0]))
        corners = {"first": min(rows), "last": max(rows), "lowest": up[0], "highest": up[-1]}
        assert got[key] == corners, key


def test_points_are_bounded_and_combined_before_the_shuffle(spark):
    df = spark.range(50_000).select(
        F.lit("r").alias("run_label"),
        F.timestamp_micros(F.col("id") * 1000).alias("timestamp"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("inference_time_ms"),
    )
    out = timeline.plot_points(df, width=50)
    assert out.count() == 200
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and "ObjectHash" not in text


def test_merged_states_keep_the_bound(spark):
    rng = random.Random(5)
    data = [(f"run{i % 3}", i % 7, math.exp(rng.gauss(3, 1.5))) for i in range(40_000)]
    data += [("run0", 0, None), ("run0", 0, math.nan), ("empty", 0, None)]
    df = spark.createDataFrame(data, "run string, day int, ms double")
    states = sketches.latency_states(df, {"ms": F.col("ms")}, ["run", "day"])
    assert states.count() == 21
    for by in (["run"], []):
        for r in sketches.state_stats(sketches.merged_states(states, by)).collect():
            values = sorted(v for run, _, v in data if v is not None and v == v and (not by or run == r.run))
            assert r.rows == len(values) and r.min == values[0] and r.max == values[-1]
            assert abs(r["mean"] - sum(values) / len(values)) < 1e-6
            for name, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
                rank = sum(v <= r[name] for v in values) / len(values)
                assert abs(rank - p) <= sketches.RANK_ERROR + 1 / len(values)
    assert sketches.merged_states(states.limit(0), ["run"]).collect() == []
