import re

import pytest
from pyspark.sql import functions as F

from loadlens.operators import sampling, selection
from loadlens.operators.partitions import spread_for_scoring, tasks_for, waves
from loadlens.operators.sequence import dense_sequence
from tests.helpers import plan, rows


def hot(spark, n=3000):
    """A third of the rows in one group, the rest spread thinly."""
    group = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 50))
    return spark.range(n).repartition(7).select(
        group.alias("g"), F.pmod(F.xxhash64("id"), F.lit(500)).alias("t"), F.col("id")
    )


@pytest.mark.parametrize("by", [[], ["g"]])
def test_dense_numbers(spark, by):
    df = hot(spark)
    got = dense_sequence(df, ["t", "id"], by, start=0).collect()
    groups = {}
    for r in got:
        groups.setdefault(tuple(r[c] for c in by), []).append((r.t, r.id, r.seq))
    assert sum(len(v) for v in groups.values()) == 3000
    for members in groups.values():
        assert [m[2] for m in sorted(members)] == list(range(len(members)))


def test_numbering_has_no_group_window_over_rows(spark):
    out = dense_sequence(hot(spark), ["t", "id"], ["g"])
    assert "row_number" not in plan(out)


@pytest.mark.parametrize("k", [4, 1500, 20_000])
def test_balanced_sample(spark, k):
    df = hot(spark, 6000)
    got = sampling.balanced_sample(df, k, "g", ["t", "id"]).collect()
    want = {}
    for r in df.collect():
        want.setdefault(r.g, []).append((r.t, r.id))
    want = {(g, *m) for g, members in want.items() for m in sorted(members)[:k]}
    assert {(r.g, r.t, r.id) for r in got} == want and len(got) == len(want)


def test_nothing_is_kept_after_numbers_and_samples(spark):
    assert sampling.first_n(hot(spark), 7, ["t", "id"]).count() == 7
    assert dense_sequence(hot(spark), ["t", "id"], ["g"]).count() == 3000
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_runnable_sizes():
    assert sampling.runnable_sizes([100, 20, 50, 20, 0], 60) == [20, 50]
    assert sampling.runnable_sizes([100], 60, otherwise=20) == [20]
    assert sampling.runnable_sizes([100], 7, otherwise=20) == [7]
    for rows_there in (60, 0):
        with pytest.raises(ValueError, match="none of the sizes"):
            sampling.runnable_sizes([100], rows_there)
    with pytest.raises(ValueError, match="none of the sizes"):
        sampling.runnable_sizes([100], 0, otherwise=20)


def test_size_ladder(spark):
    df = spark.range(60).select(F.format_string("req_%08d", "id").alias("request_id"))
    got = sampling.size_ladder(df, [50, 20, 100], ["request_id"])
    counts = rows(got.groupBy("run_label", "run_size").count(), "run_label")
    assert counts == [("run_001_20reqs", 20, 20), ("run_002_50reqs", 50, 50)]
    first = got.filter("run_size = 20").agg(F.max("request_id")).first()[0]
    assert first == "req_00000019"
    with pytest.raises(ValueError):
        sampling.size_ladder(df.limit(0), [5], ["request_id"])
    text = plan(got)
    assert "TakeOrdered" not in text


def test_two_class_sample(spark):
    df = spark.createDataFrame([("A", f"p{i}") for i in range(9)] + [("B", "q")], "l string, p string")
    got = sampling.two_class_sample(df, 6, ("A", "B"), "l", ["p"])
    assert rows(got, "l", "p") == [("A", "p0"), ("A", "p1"), ("A", "p2"), ("B", "q")]


def test_waves_keep_every_slot_busy():
    assert [waves(n, 4) for n in (0, 1, 3, 100, 800, 801, 10_000)] == [1, 1, 3, 4, 4, 8, 52]
    for n in (5, 799, 12_345, 10**9):
        tasks = waves(n, 16)
        assert -(-n // tasks) <= 200 and (tasks % 16 == 0 or tasks == n)


def test_tasks_for(spark):
    df = spark.createDataFrame([(0,), (200,), (201,), (10**9,)], "n long")
    assert [r[0] for r in df.select(tasks_for(F.col("n"), 64)).collect()] == [1, 1, 2, 64]


def test_spread(spark):
    assert spread_for_scoring(spark.range(500), 3).rdd.getNumPartitions() == 3


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("n", [3, 700])
def test_rows_up_to_the_nth_key(spark, monkeypatch, by, n):
    monkeypatch.setattr(selection, "SPARE", 60)
    monkeypatch.setattr(selection, "SAMPLE", 200)
    df = hot(spark, 20_000).withColumn("t", F.when(F.col("t") % 9 > 0, F.col("t")))
    got = selection.rows_up_to(df, n, ["t", "id"], by).collect()
    groups = {}
    for r in df.collect():
        groups.setdefault(tuple(r[c] for c in by), []).append((r.t is not None, r.t or 0, r.id))
    left = {}
    for r in got:
        left.setdefault(tuple(r[c] for c in by), []).append((r.t is not None, r.t or 0, r.id))
    assert set(left) == set(groups)
    for g, members in groups.items():
        members.sort()
        assert sorted(left[g]) == members[: len(left[g])]
        assert min(n, len(members)) <= len(left[g]) <= n + 120


def test_equal_keys_end_the_selection(spark, monkeypatch):
    monkeypatch.setattr(selection, "SPARE", 10)
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), F.lit(float("nan")).alias("v"))
    assert selection.rows_up_to(df, 1200, ["k", "v"]).groupBy("k").count().count() == 2
    assert selection.rows_up_to(df, 5, ["v"]).count() == 3000
    assert selection.rows_up_to(df.limit(0), 5, ["v"]).count() == 0


def above_the_scan(text):
    """The steps that rows take from the file on: the lines above the scan, parent by parent."""

    def depth(line):
        return re.search(r"[A-Za-z*(]", line).start()

    lines = [line for line in text.splitlines() if re.search("[A-Za-z]", line)]
    at = next(i for i, line in enumerate(lines) if "FileScan" in line)
    found, least = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < least:
            found.append(line)
            least = depth(line)
    return found


@pytest.mark.parametrize("by", [[], ["g"]])
def test_first_rows_are_chosen_before_the_shuffle(spark, monkeypatch, tmp_path, by):
    """What is left is about n rows a group, and it is a filter of what is read: no row has moved."""
    monkeypatch.setattr(selection, "SPARE", 2_000)
    hot(spark, 200_000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    near = selection.rows_up_to(df, 5_000, ["t", "id"], by)
    assert not [line for line in above_the_scan(plan(near)) if "Exchange" in line]
    groups = near.groupBy(*by).count().collect()
    assert all(r["count"] <= 7_100 for r in groups)
    assert sampling.first_n(df, 5_000, ["t", "id"]).count() == 5_000
