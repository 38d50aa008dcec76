"""Recorded inputs and outputs of earlier load tests, retyped."""

import pytest

from loadlens.operators import labels, metrics
from loadlens.plans import capacity
from tests.helpers import pred_row, preds, rows

TWENTY = [
    2941.7354, 589.3731, 471.86923, 398.66043, 2915.9521, 527.59937, 556.19574, 3134.7568,
    536.1178, 3239.3582, 530.65326, 4020.2017, 3378.2678, 556.9932, 2875.8557, 499.78568,
    632.5841, 3282.6604, 572.478, 634.88745,
]
FIVE = [6013.94921875, 6013.94921875, 6013.94921875, 6013.94921875, 14616.0244140625]
LENGTHS = [1785, 1714, 1615, 1469, 1513]
RUNS = [
    ("run_001_20imgs", 20, 117.24287748336792, 0.17058605545430425),
    ("run_002_50imgs", 50, 262.460009098053, 0.1905052132392497),
    ("run_003_100imgs", 100, 499.2302167415619, 0.20030838808734874),
    ("run_004_200imgs", 200, 989.2831082344055, 0.20216659754450295),
    ("run_005_500imgs", 500, 1316.2368874549866, 0.3798708308249713),
    ("run_006_1000imgs", 1000, 2572.7353785037994, 0.38869135487286693),
]
# Seconds to clear 100, 1000 and 10000 requests of four images, per run.
DRAIN = [
    (2344.8575496673584, 23448.575496673584, 234485.75496673584),
    (2099.680072784424, 20996.80072784424, 209968.00727844238),
    (1996.9208669662473, 19969.208669662476, 199692.08669662476),
    (1978.566216468811, 19785.66216468811, 197856.6216468811),
    (1052.9895099639893, 10529.895099639893, 105298.95099639893),
    (1029.0941514015199, 10290.941514015198, 102909.41514015198),
]


@pytest.mark.parametrize("options", [{}, {"method": "sketch"}])
def test_latency_of_twenty(spark, options):
    pred = preds(spark, [pred_row(i, ms) for i, ms in enumerate(TWENTY)])
    got = rows(metrics.latency_stats(pred, **options))
    assert got == [(1614.8, 398.66, 4020.2, 589.37, 3378.27, 4020.2)]


@pytest.mark.parametrize("options", [{}, {"method": "sketch"}])
def test_latency_of_five(spark, options):
    pred = preds(spark, [pred_row(i, ms) for i, ms in enumerate(FIVE)])
    got = rows(metrics.latency_stats(pred, **options))
    assert got == [(7734.36, 6013.95, 14616.02, 6013.95, 14616.02, 14616.02)]


def test_throughput_and_status_of_twenty(spark):
    pred = preds(spark, [pred_row(i, ms) for i, ms in enumerate(TWENTY)])
    assert rows(metrics.throughput(pred)) == [(20, 1, 32.3, 0.62)]
    assert rows(metrics.status_share(pred)) == [("Success", 20, 100.0)]


def test_text_lengths_of_five(spark):
    pred = preds(spark, [pred_row(i, text="x" * n) for i, n in enumerate(LENGTHS)])
    assert rows(metrics.text_length_stats(pred)) == [(1619.2, 1469.0, 1785.0, 1615.0, 1785.0)]


def test_classes_of_twenty(spark):
    pairs = [("NORMAL", "NORMAL")] * 19 + [("NORMAL", "PNEUMONIA")]
    df = spark.createDataFrame(pairs, "true_label string, predicted_label string")
    assert rows(labels.accuracy(df)) == [(20, 19, 95.0)]
    assert rows(labels.per_class_accuracy(df)) == [("NORMAL", 20, 19, 95.0)]
    assert rows(labels.confusion(df), "predicted_label") == [
        ("NORMAL", "NORMAL", 19),
        ("NORMAL", "PNEUMONIA", 1),
    ]
    assert rows(labels.prediction_distribution(df), "predicted_label") == [
        ("NORMAL", 19, 95.0),
        ("PNEUMONIA", 1, 5.0),
    ]


def test_burst_drain(spark):
    runs = spark.createDataFrame(
        RUNS, "run_label string, num_images int, wall_time_sec double, rate double"
    )
    got = rows(capacity.burst_drain(runs, "rate"), "run_label", "concurrent_requests")
    assert [r[6] for r in got] == [x for run in DRAIN for x in run]
    assert [r[7] for r in got] == [x / 60.0 for run in DRAIN for x in run]
    by_request = capacity.burst_drain(runs, "rate", unit="requests")
    assert by_request.agg({"time_to_clear_sec": "max"}).first()[0] == pytest.approx(
        10000 / RUNS[0][3]
    )


def test_runs_without_rate_do_not_drain(spark):
    runs = spark.createDataFrame([("a", None), ("b", 0.0)], "run_label string, rate double")
    assert capacity.burst_drain(runs, "rate").count() == 0


def test_cross_run_figures(spark):
    runs = spark.createDataFrame(
        RUNS, "run_label string, num_images int, wall_time_sec double, rate double"
    )
    order = ("num_images", "run_label")
    speed = rows(capacity.scaling_efficiency(runs, "rate", order), "num_images")
    assert speed[0][3:] == (1.0, 100.0)
    assert speed[-1][3] == pytest.approx(0.38869135487286693 / 0.17058605545430425)
    line = rows(capacity.linear_projection(runs, "wall_time_sec", "num_images", order), "num_images")
    assert line[0][2] == pytest.approx(line[0][3])
    assert line[-1][3] == pytest.approx(1000 * RUNS[0][2] / 20 / 60)
    parts = {r[0]: r for r in rows(capacity.time_breakdown(runs, "wall_time_sec", order))}
    assert parts["Model Loading"][1] == 15.0
    assert parts["I/O"][1] == pytest.approx((RUNS[-1][2] - 15) * 0.1)
    assert sum(p[2] for p in parts.values()) == pytest.approx(100.0)


def test_cost_is_flat_and_fewest_devices_win(spark):
    base = spark.createDataFrame([(0.25,)], "rate double")
    costs = capacity.cost_projection(base)
    values = [r.cost_usd for r in costs.collect()]
    assert max(values) - min(values) < 1e-9
    assert rows(capacity.cheapest_devices(costs))[0][0] == 1
    hours = {(r.items, r.devices): r for r in capacity.hours_to_process(base).collect()}
    assert hours[(1000, 1)].hours == pytest.approx(1000 / (0.25 * 0.95) / 3600)
    assert hours[(1000, 1)].within_limit and not hours[(10_000_000, 64)].within_limit
