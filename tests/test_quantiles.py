"""Exact percentiles against sorting, on values that are hard for sketches and cells."""

import math
import random
import struct

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadlens.operators import quantiles
from loadlens.operators.quantiles import (
    exact_percentiles,
    grouped_with_percentiles,
    ordered_key,
    wide,
)

PROBS = [0.5, 0.95, 0.99]


def brute(values, p):
    ordered = sorted(v for v in values if v is not None)
    k = round(p * 1_000_000)
    rank = max(1, -(-k * len(ordered) // 1_000_000))
    return ordered[rank - 1]


def check(spark, data, **options):
    df = spark.createDataFrame(data, "g string, v double")
    names = {("v", p): f"p{i}" for i, p in enumerate(PROBS)}
    long = exact_percentiles(df, {"v": F.col("v")}, PROBS, ["g"], **options)
    got = {r.g: (r.p0, r.p1, r.p2) for r in wide(long, names, ["g"]).collect()}
    groups = {g for g, v in data if v is not None}
    assert set(got) == groups
    for g in groups:
        values = [v for h, v in data if h == g]
        assert got[g] == tuple(brute(values, p) for p in PROBS), g


def test_shapes(spark):
    rnd = random.Random(7)
    data = [("uniform", rnd.random()) for _ in range(20000)]
    data += [("heavy tail", math.exp(rnd.gauss(0, 6))) for _ in range(20000)]
    data += [("one outlier", rnd.random()) for _ in range(5000)] + [("one outlier", 1e15)]
    data += [("two values", float(rnd.random() < 0.95)) for _ in range(3000)]
    data += [("constant", 3.0)] * 500 + [("single", -2.5)] + [("none", None)]
    data += [("signed", rnd.uniform(-1e6, 1e6)) for _ in range(999)]
    data += [(None, float(i)) for i in range(100)]
    check(spark, data)


@pytest.mark.parametrize("accuracy,cells", [(20, 4), (1000, 2)])
def test_poor_sketch_stays_exact(spark, accuracy, cells):
    rnd = random.Random(3)
    data = [("a", rnd.gauss(0, 1)) for _ in range(4000)] + [("b", float(i % 7)) for i in range(900)]
    check(spark, data, accuracy=accuracy, cells=cells)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.one_of(st.none(), st.floats(-1e12, 1e12), st.integers(0, 5).map(float)),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_any_values(spark, data):
    check(spark, data)


def test_two_humps(spark):
    """The bracket of the median spans the gap, so one cell holds a hump and is cut again."""
    rnd = random.Random(5)
    data = [("h", rnd.gauss(0, 1)) for _ in range(3000)]
    data += [("h", rnd.gauss(1e9, 1)) for _ in range(3000)] + [("c", 7.0)] * 2000
    check(spark, data, accuracy=50, cell_rows=40)
    check(spark, data, accuracy=50, cells=3, cell_rows=5)


def test_rank_is_that_of_whole_numbers(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("v"))
    probs = [0.07, 0.14, 0.28, 0.55, 0.56]
    got = {r.p: r.value for r in exact_percentiles(df, {"v": F.col("v")}, probs).collect()}
    assert got == {0.07: 7.0, 0.14: 14.0, 0.28: 28.0, 0.55: 55.0, 0.56: 56.0}


def test_scans(spark, tmp_path):
    """The aggregates, the cells and the values: three reads of the input, one of them done."""
    spark.range(5000).selectExpr("id % 3 AS g", "rand(1) AS v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    names = {("v", p): f"p{i}" for i, p in enumerate(PROBS)}
    out = grouped_with_percentiles(df, ["g"], [F.avg("v").alias("m")], {"v": F.col("v")}, names)
    assert out.count() == 3
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 3
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_several_columns_without_groups(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("a"), (-F.col("id")).alias("b"))
    long = exact_percentiles(df, {"a": F.col("a"), "b": F.col("b")}, PROBS)
    got = {(r.metric, r.p): r.value for r in long.collect()}
    assert got[("a", 0.5)] == 500.0 and got[("a", 0.99)] == 990.0
    assert got[("b", 0.5)] == -501.0 and got[("b", 0.95)] == -51.0


def test_no_rows(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert exact_percentiles(df, {"v": F.col("v")}, PROBS, ["g"]).count() == 0
    assert exact_percentiles(df, {"v": F.col("v")}, PROBS).count() == 0


def test_no_single_task_holds_rows(spark):
    """Only counters reach the windows: every exchange below one carries aggregated cells."""
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    text = exact_percentiles(df, {"v": F.col("v")}, PROBS)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text
    assert "collect_list(v" not in text


def test_keys_order_as_doubles(spark):
    hard = [0.0, -0.0, 5e-324, 2.2250738585072009e-308, 2.2250738585072014e-308, 1.0, 0.1, 1 / 3]
    hard += [2.0**k for k in range(-1074, 1024, 13)] + [math.nextafter(2.0**k, 0) for k in range(-1022, 1024, 7)]
    hard += [math.nextafter(2.0**k, math.inf) for k in range(-1022, 1024, 11)] + [1.7976931348623157e308]
    rnd = random.Random(2)
    hard += [struct.unpack("<d", struct.pack("<Q", rnd.getrandbits(63)))[0] for _ in range(3000)]
    values = [v for v in hard + [-v for v in hard] if v == v] + [math.inf, -math.inf]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for v, key in df.select("v", ordered_key(F.col("v"))).collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
        assert key == (-bits if v < 0 else bits), v
    nan = spark.range(1).select(ordered_key(F.lit(float("nan")))).first()[0]
    assert nan > struct.unpack("<q", struct.pack("<d", math.inf))[0]


ODD = [math.nan, math.inf, -math.inf, 1.7976931348623157e308, -1.7976931348623157e308, 0.0, -0.0]


def as_sql(v):
    """NaN above all, as SQL orders it."""
    return (v != v, 0.0 if v != v else v)


@pytest.mark.parametrize("few", [3, 40])
def test_infinities_and_nan_end_in_few_rounds(spark, monkeypatch, few):
    rnd = random.Random(1)
    values = [float(i) for i in range(1, 101)] + ODD * few + [rnd.gauss(0, 1e300) for _ in range(60)]
    df = spark.createDataFrame([("hot", v) for v in values] + [("other", math.nan)], "g string, v double")
    rounds = []
    real = quantiles._finer_cells
    monkeypatch.setattr(quantiles, "_finer_cells", lambda *a: rounds.append(1) or real(*a))
    probs = [0.01, 0.1, 0.5, 0.9, 0.95, 0.99, 1.0]
    found = exact_percentiles(df, {"v": F.col("v")}, probs, ["g"], accuracy=10, cell_rows=5)
    got = {(r.g, r.p): r.value for r in found.collect()}
    ordered = sorted(values, key=as_sql)
    for p in probs:
        want = ordered[max(1, -(-round(p * 1e6) * len(ordered) // 1_000_000)) - 1]
        assert as_sql(got["hot", p]) == as_sql(want), p
        assert math.isnan(got["other", p])
    assert len(rounds) <= 6
