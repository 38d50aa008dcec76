import pytest
from pyspark.sql import functions as F

from loadlens.operators import metrics, timeline, trend
from loadlens.plans import runs
from tests.helpers import MOMENT, plan, pred_row, preds, rows


def test_errors_do_not_count_as_latency(spark):
    data = [pred_row(i, ms=float(i)) for i in range(1, 11)] + [pred_row(99, 9999.0, "ValueError: x")]
    stats = rows(metrics.latency_stats(preds(spark, data)))[0]
    assert stats == (5.5, 1.0, 10.0, 5.0, 10.0, 10.0)
    share = rows(metrics.status_share(preds(spark, data)), "status")
    assert share == [("Error", 1, 9.09), ("Success", 10, 90.91)]


@pytest.mark.parametrize("options", [{}, {"method": "sketch"}])
def test_all_failed_run_gives_nulls(spark, options):
    pred = preds(spark, [pred_row(i, 0.0, "Model load failed: x") for i in range(5)])
    assert rows(metrics.latency_stats(pred, **options)) == [(None,) * 6]
    assert rows(metrics.throughput(pred)) == [(0, 0, None, None)]
    assert rows(metrics.status_share(pred)) == [("Error", 5, 100.0)]
    assert rows(metrics.status_totals(pred)) == [(0, 5, 0.0)]


def test_empty_table(spark):
    pred = preds(spark, [])
    assert rows(metrics.status_totals(pred)) == [(0, 0, None)]
    assert rows(metrics.status_share(pred)) == []
    assert rows(metrics.histogram(pred, F.col("inference_time_ms"))) == []


def test_zero_time_gives_no_rate(spark):
    pred = preds(spark, [pred_row(1, 0.0), pred_row(2, 0.0, gpu="B-1")])
    assert rows(metrics.throughput(pred)) == [(2, 2, 0.0, None)]


def test_null_group_is_a_group(spark):
    data = [pred_row(1, label="A"), pred_row(2, label=None), pred_row(4, label=None)]
    got = rows(metrics.latency_stats(preds(spark, data), by=["true_label"]), "true_label")
    assert [(r[0], r[1], r[4]) for r in got] == [(None, 3.0, 2.0), ("A", 1.0, 1.0)]
    by_run = rows(metrics.share(preds(spark, data), F.col("true_label"), "l", ["run_label"]), "l")
    assert by_run == [("run_001", None, 2, 66.67), ("run_001", "A", 1, 33.33)]


def test_shares_sum_to_hundred(spark):
    df = spark.range(997).select(F.pmod(F.xxhash64("id"), F.lit(13)).alias("k"))
    total = metrics.share(df, F.col("k"), "k", digits=None).agg(F.sum("percentage")).first()[0]
    assert total == pytest.approx(100.0)


def test_histogram_covers_all_rows(spark):
    df = spark.range(1000).select((F.col("id") * F.col("id")).cast("double").alias("v"))
    got = rows(metrics.histogram(df, F.col("v")), "bin")
    assert len(got) == 30 and sum(r[3] for r in got) == 1000
    assert got[0][1] == 0.0 and got[-1][2] == pytest.approx(999.0**2)
    for _, start, end, n in got[:-1]:
        assert n == sum(start <= i * i < end for i in range(1000))


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(4.0,)] * 3, "v double")
    got = [r for r in rows(metrics.histogram(df, F.col("v")), "bin") if r[3]]
    assert got == [(15, pytest.approx(4.0), pytest.approx(4.0 + 1 / 30), 3)]


def test_total_row(spark):
    pred = preds(spark, [pred_row(1), pred_row(2), pred_row(3, label="PNEUMONIA")])
    assert sorted(rows(metrics.class_counts(pred))) == [("NORMAL", 2), ("PNEUMONIA", 1), ("TOTAL", 3)]


def test_only_needed_columns_are_read(spark, tmp_path):
    path = str(tmp_path / "p")
    preds(spark, [pred_row(i) for i in range(50)]).write.parquet(path)
    stored = spark.read.parquet(path)
    text = plan(metrics.latency_stats(stored))
    assert "ReadSchema: struct<inference_time_ms:double,error_message:string>" in text
    assert "IsNull(error_message)" in text


def test_ordering_of_figures(spark):
    rnd = [((i * 7919) % 1009) / 3.0 for i in range(500)]
    pred = preds(spark, [pred_row(i, ms) for i, ms in enumerate(rnd)])
    mean, low, high, p50, p95, p99 = rows(metrics.latency_stats(pred))[0]
    assert low <= p50 <= p95 <= p99 <= high and low <= mean <= high


def test_bundle_equals_single_tables(spark):
    data = [pred_row(i, run=f"run_{i % 3}", wait=i, text="x" * i) for i in range(60)]
    data += [pred_row(100 + i, 1.0, "E: e", run="run_1") for i in range(5)]
    pred = preds(spark, data)
    got = {
        (r.run_label, r.metric_table, r.metric): r.value for r in runs.metric_bundle(pred).collect()
    }
    for r in metrics.latency_stats(pred, "end_to_end_ms", ["run_label"]).collect():
        for name in ("mean", "min", "max", "p50", "p95", "p99"):
            assert got[(r.run_label, "end_to_end_stats", name)] == r[f"{name}_ms"]
    assert got[("run_1", "error_statistics", "error_count")] == 5
    assert got[("run_0", "throughput_metrics", "total_requests")] == 20


def test_tables_of_one_pass_equal_single_tables(spark):
    data = [pred_row(i, run=f"run_{i % 3}", wait=i, text="x" * i) for i in range(60)]
    data += [pred_row(100 + i, 1.0, "E: e", run="run_1") for i in range(5)]
    pred = preds(spark, data).withColumn("dequeue_ts", F.lit(MOMENT))
    pred = pred.withColumn("timestamp", F.expr("dequeue_ts + INTERVAL 2 SECONDS"))
    made = runs.load_test_tables(pred)
    by = ["run_label"]
    single = {
        "inference_latency_stats": metrics.latency_stats(pred, by=by),
        "queue_wait_stats": metrics.latency_stats(pred, "queue_wait_ms", by),
        "throughput_metrics": metrics.throughput(pred, by),
        "error_statistics": metrics.status_share(pred, by),
        "report_length_statistics": metrics.text_length_stats(pred, by=by),
        "load_test_summary": runs.run_report(pred),
    }
    for name, table in single.items():
        assert made[name].columns == table.columns, name
        assert rows(made[name], *table.columns[:2]) == rows(table, *table.columns[:2]), name


def timed(spark, offsets, run="r"):
    data = [(run, f"k{i:03d}", MOMENT, float(i), s) for i, s in enumerate(offsets)]
    df = spark.createDataFrame(
        data, "run_label string, request_id string, t timestamp, inference_time_ms double, s double"
    )
    later = F.timestamp_micros(F.unix_micros("t") + F.round(F.col("s") * 1e6).cast("bigint"))
    return df.withColumn("timestamp", later).drop("t", "s")


def test_timeline(spark):
    got = rows(timeline.timeline(timed(spark, [2.0, 0.0, 0.5])), "request_id")
    assert [r[-1] for r in got] == [2.0, 0.0, 0.5]
    assert {r[-2] for r in got} == {1.0}


def test_runs_without_times_keep_their_rows(spark):
    blank = timed(spark, [0.0, 9.0], "blank").withColumn("timestamp", F.lit(None).cast("timestamp"))
    mixed = timed(spark, [0.0, 9.0, 3.0], "mixed").withColumn(
        "timestamp", F.when(F.col("request_id") != "k002", F.col("timestamp"))
    )
    got = timeline.timeline_adaptive(blank.unionByName(mixed)).collect()
    found = {(r.run_label, r.request_id): r.x for r in got}
    assert found == {
        ("blank", "k000"): 1.0, ("blank", "k001"): 2.0,
        ("mixed", "k000"): 0.0, ("mixed", "k001"): 9.0, ("mixed", "k002"): None,
    }


def test_short_runs_are_numbered(spark):
    df = timed(spark, [0.3, 0.1, 0.2], "short").unionByName(timed(spark, [0.0, 5.0], "long"))
    out = timeline.timeline_adaptive(df)
    got = {(r.run_label, r.request_id): (r.x_label, r.x) for r in out.collect()}
    assert got[("short", "k000")] == ("Image Number", 3.0)
    assert got[("short", "k001")] == ("Image Number", 1.0)
    assert got[("long", "k001")] == ("Time Elapsed (sec)", 5.0)


def test_trends(spark):
    df = spark.range(50).select(
        F.col("id").cast("double").alias("x"),
        (F.col("id") * 3.0 + 2.0).alias("line"),
        (F.col("id") * F.col("id") * 0.5 - F.col("id") + 4.0).alias("curve"),
    )
    assert rows(trend.linear_trend(df, "x", "line"))[0] == pytest.approx((3.0, 2.0))
    points = rows(trend.quadratic_points(trend.quadratic_trend(df, "x", "curve")), "point")
    assert len(points) == 100
    for _, x, y in points:
        assert y == pytest.approx(0.5 * x * x - x + 4.0)


def test_too_few_points_give_no_curve(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 5.0)], "x double, y double")
    a, b, c = rows(trend.quadratic_trend(df, "x", "y"))[0][2:]
    assert (a, b, c) == (None, None, None)
