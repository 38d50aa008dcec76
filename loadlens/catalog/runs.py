"""Run summaries, cross-run comparison and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.catalog.registry import query
from loadlens.catalog.views import P, R, predictions, runs
from loadlens.functions import times
from loadlens.plans import capacity
from loadlens.plans import runs as plans
from loadlens.scratch import scratch_path
from loadlens.sinks.files import write_csv
from loadlens.sources.tables import backfill_summary, read_summary


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = {n for n, t in df.dtypes if t == "double"}
    return df.select(*[F.round(c, digits).alias(c) if c in doubles else c for c in df.columns])


@query(
    "run_view",
    f"WITH {R} SELECT run_label, num_requests, round(busy_sec, 6) AS busy_sec, "
    "round(throughput_per_sec, 6) AS throughput_per_sec, round(mean_ms, 6) AS mean_ms, p95_ms FROM R",
)
def run_view(spark, sf_dir) -> DataFrame:
    return _rounded(runs(spark, sf_dir))


_OK = "FILTER (WHERE error_message IS NULL)"
_SUMMARY = (
    f"""{P},
W AS (SELECT run_label, count(*) AS num_requests, count(*) {_OK} AS success_count,
  count(*) - count(*) {_OK} AS error_count,
  (max(done_us) - min(dequeue_us)) / 1000000.0 AS wall_time_sec,
  count(*) / ((max(done_us) - min(dequeue_us)) / 1000000.0) AS wall_throughput_req_per_sec,"""
    + ", ".join(
        f"avg({c}) {_OK} AS {n}_mean_ms, quantile_disc({c}, 0.95) {_OK} AS {n}_p95_ms"
        for c, n in (
            ("queue_wait_ms", "queue_wait"),
            ("inference_time_ms", "inference"),
            ("end_to_end_ms", "end_to_end"),
        )
    )
    + " FROM P GROUP BY run_label)"
)
_SUMMARY_COLUMNS = (
    "run_label, num_requests, success_count, error_count, round(wall_time_sec, 6) AS wall_time_sec, "
    "round(wall_throughput_req_per_sec, 6) AS wall_throughput_req_per_sec, "
    + ", ".join(
        f"round({n}_{k}_ms, 6) AS {n}_{k}_ms"
        for n in ("queue_wait", "inference", "end_to_end")
        for k in ("mean", "p95")
    )
)


@query("run_summary", f"WITH {_SUMMARY} SELECT {_SUMMARY_COLUMNS} FROM W")
def run_summary(spark, sf_dir) -> DataFrame:
    return _rounded(plans.run_summary(predictions(spark, sf_dir)))


@query(
    "run_report",
    f"""WITH {_SUMMARY} SELECT {_SUMMARY_COLUMNS},
  round(success_count * 100.0 / num_requests, 6) AS success_rate_pct,
  round(success_count * 1000.0 / (inference_mean_ms * success_count), 6) AS serial_throughput_per_sec,
  round(success_count * 1000.0 / (inference_mean_ms * success_count) * 86400, 4) AS daily_capacity
FROM W""",
)
def run_report(spark, sf_dir) -> DataFrame:
    out = plans.run_report(predictions(spark, sf_dir))
    return _rounded(out.withColumn("daily_capacity", F.round("daily_capacity", 4)))


_DATASET = f"""WITH {_SUMMARY} SELECT run_label, num_requests AS num_images,
  round(wall_time_sec, 6) AS wall_time_sec,
  round(wall_throughput_req_per_sec, 6) AS wall_throughput_img_per_sec,
  round(inference_mean_ms, 6) AS mean_latency_ms, round(inference_p95_ms, 6) AS p95_latency_ms,
  success_count, error_count, CAST(NULL AS DOUBLE) AS overall_accuracy_pct FROM W"""


@query("dataset_summary", _DATASET)
def dataset_summary(spark, sf_dir) -> DataFrame:
    return _rounded(plans.dataset_summary(predictions(spark, sf_dir)))


@query("summary_csv", _DATASET)
def summary_csv(spark, sf_dir) -> DataFrame:
    """The summary file written and read back."""
    path = scratch_path(spark, "summary")
    write_csv(plans.dataset_summary(predictions(spark, sf_dir)), path, single_file=True)
    return _rounded(read_summary(spark, path))


@query(
    "demo_summary",
    f"""WITH {P} SELECT run_label, max(done_us) AS finished_us, true AS s3_enabled,
  false AS kafka_enabled, count(*) AS total_images, count(*) {_OK} AS success_count,
  count(*) - count(*) {_OK} AS error_count, round(avg(inference_time_ms) {_OK}, 6) AS mean_latency_ms,
  quantile_disc(inference_time_ms, 0.95) {_OK} AS p95_latency_ms,
  quantile_disc(inference_time_ms, 0.99) {_OK} AS p99_latency_ms,
  round(count(*) {_OK} / (sum(inference_time_ms) {_OK} / 1000), 6) AS throughput_img_per_sec,
  round((max(done_us) - min(dequeue_us)) / 1000000.0, 6) AS wall_time_sec
FROM P GROUP BY run_label""",
)
def demo_summary(spark, sf_dir) -> DataFrame:
    out = plans.demo_summary(predictions(spark, sf_dir), True, False)
    return _rounded(out.withColumn("finished_us", times.micros("timestamp")).drop("timestamp"))


_LEVELS = "(SELECT unnest([100, 1000, 10000])::BIGINT AS level)"


def _burst(rate: str) -> str:
    return f"""WITH {R} SELECT run_label, level AS concurrent_requests,
  CAST(4 AS INTEGER) AS request_size_images, level * 4 AS total_images,
  round(throughput_per_sec, 6) AS throughput_per_sec, round({rate}, 6) AS images_per_sec,
  round(level * 4 / ({rate}), 6) AS time_to_clear_sec,
  round(level * 4 / ({rate}) / 60.0, 6) AS time_to_clear_min
FROM R CROSS JOIN {_LEVELS} WHERE throughput_per_sec > 0"""


@query("burst_drain", _burst("throughput_per_sec"))
def burst_drain(spark, sf_dir) -> DataFrame:
    return _rounded(capacity.burst_drain(runs(spark, sf_dir)))


@query("burst_drain_requests", _burst("throughput_per_sec * 4"))
def burst_drain_requests(spark, sf_dir) -> DataFrame:
    return _rounded(capacity.burst_drain(runs(spark, sf_dir), unit="requests"))


_FIRST = "first_value({}) OVER (ORDER BY num_requests, run_label)"


@query(
    "scaling_efficiency",
    f"""WITH {R}, S AS (SELECT *, throughput_per_sec / {_FIRST.format("throughput_per_sec")} AS s FROM R)
SELECT num_requests, run_label, round(throughput_per_sec, 6) AS throughput_per_sec,
  round(s, 6) AS speedup, round(s * 100, 6) AS efficiency_pct FROM S""",
)
def scaling_efficiency(spark, sf_dir) -> DataFrame:
    return _rounded(capacity.scaling_efficiency(runs(spark, sf_dir)))


@query(
    "linear_projection",
    f"""WITH {R} SELECT num_requests, run_label, round(busy_sec / 60, 6) AS actual_min,
  round(num_requests * ({_FIRST.format("busy_sec")} / {_FIRST.format("num_requests")}) / 60, 6)
    AS linear_min FROM R""",
)
def linear_projection(spark, sf_dir) -> DataFrame:
    return _rounded(capacity.linear_projection(runs(spark, sf_dir)))


@query(
    "daily_capacity",
    f"""WITH {R} SELECT run_label, round(throughput_per_sec * 86400, 4) AS daily_capacity,
  round(throughput_per_sec * 86400 / 1000, 4) AS daily_capacity_k FROM R""",
)
def daily_capacity(spark, sf_dir) -> DataFrame:
    return _rounded(capacity.daily_capacity(runs(spark, sf_dir)), 4)


@query(
    "load_size_table",
    f"""WITH {R} SELECT run_label, num_requests, round(throughput_per_sec, 6) AS throughput_per_sec,
  round(mean_ms, 6) AS mean_ms FROM R""",
)
def load_size_table(spark, sf_dir) -> DataFrame:
    return _rounded(capacity.load_size_table(runs(spark, sf_dir)))


_OLD_SUMMARY = f"""{R}, O AS (SELECT run_label, num_requests AS num_images, busy_sec AS wall_time_sec,
  throughput_per_sec AS wall_throughput_img_per_sec FROM R)"""


def _old_summary(spark, sf_dir) -> DataFrame:
    """Runs in the columns of an early summary file, before counts and latencies were kept."""
    return runs(spark, sf_dir).selectExpr(
        "run_label",
        "num_requests AS num_images",
        "busy_sec AS wall_time_sec",
        "throughput_per_sec AS wall_throughput_img_per_sec",
    )


@query(
    "summary_backfill",
    f"""WITH {_OLD_SUMMARY} SELECT run_label, num_images, round(wall_time_sec, 6) AS wall_time_sec,
  round(wall_throughput_img_per_sec, 6) AS wall_throughput_img_per_sec,
  num_images AS success_count, CAST(0 AS BIGINT) AS error_count,
  round(1000.0 / wall_throughput_img_per_sec, 6) AS mean_latency_ms,
  round(1000.0 / wall_throughput_img_per_sec * 1.2, 6) AS p95_latency_ms FROM O""",
)
def summary_backfill(spark, sf_dir) -> DataFrame:
    return _rounded(backfill_summary(_old_summary(spark, sf_dir)))


@query(
    "summary_table",
    f"""WITH {_OLD_SUMMARY} SELECT run_label, num_images, round(wall_time_sec / 60, 2) AS minutes,
  round(wall_throughput_img_per_sec, 3) AS items_per_sec,
  CAST(floor(wall_throughput_img_per_sec * 86400) AS BIGINT) AS items_per_day,
  num_images AS success_count, CAST(0 AS BIGINT) AS error_count FROM O""",
)
def summary_table(spark, sf_dir) -> DataFrame:
    return capacity.summary_table(backfill_summary(_old_summary(spark, sf_dir)))


_BASE = f"{R}, B AS (SELECT avg(throughput_per_sec) AS rate, avg(mean_ms) AS latency_ms FROM R)"
_DEVICES = "(SELECT unnest([1, 2, 4, 8, 16, 32, 64])::BIGINT AS n)"


@query(
    "mean_rates",
    f"WITH {_BASE} SELECT round(rate, 6) AS rate, round(latency_ms, 6) AS latency_ms FROM B",
)
def mean_rates(spark, sf_dir) -> DataFrame:
    return _rounded(capacity.mean_rates(runs(spark, sf_dir)))


@query(
    "device_projection",
    f"""WITH {_BASE} SELECT n AS devices, round(rate * n * 0.95, 6) AS projected_per_sec,
  round(rate * n, 6) AS ideal_per_sec, round(rate * n * 0.95 * 86400 / 1000, 4) AS daily_capacity_k
FROM B CROSS JOIN {_DEVICES}""",
)
def device_projection(spark, sf_dir) -> DataFrame:
    out = capacity.device_projection(capacity.mean_rates(runs(spark, sf_dir)))
    return _rounded(out.withColumn("daily_capacity_k", F.round("daily_capacity_k", 4)))


@query(
    "hours_to_process",
    f"""WITH {_BASE}, H AS (SELECT items, n AS devices, items / (rate * n * 0.95) / 3600 AS hours
  FROM B CROSS JOIN (SELECT unnest([1000, 10000, 100000, 1000000, 10000000])::BIGINT AS items)
  CROSS JOIN (SELECT unnest([1, 4, 16, 64])::BIGINT AS n))
SELECT items, devices, round(hours, 6) AS hours, hours <= 24.0 AS within_limit FROM H""",
)
def hours_to_process(spark, sf_dir) -> DataFrame:
    return _rounded(capacity.hours_to_process(capacity.mean_rates(runs(spark, sf_dir))))


_COSTS = f"""{_BASE}, K AS (SELECT n AS devices, 100000 / (rate * n * 0.95) / 3600 AS hours,
  100000 / (rate * n * 0.95) / 3600 * n * 2.5 AS cost_usd,
  1.0 / (rate * n * 0.95) / 3600 * n * 2.5 * 1000 AS usd_per_1000 FROM B CROSS JOIN {_DEVICES})"""


@query(
    "cost_projection",
    f"WITH {_COSTS} SELECT devices, round(hours, 6) AS hours, round(cost_usd, 6) AS cost_usd, "
    "round(usd_per_1000, 6) AS usd_per_1000 FROM K",
)
def cost_projection(spark, sf_dir) -> DataFrame:
    return _rounded(capacity.cost_projection(capacity.mean_rates(runs(spark, sf_dir))))


@query(
    "cheapest_devices",
    f"WITH {_COSTS} SELECT devices, round(cost_usd, 6) AS cost_usd FROM K "
    "ORDER BY round(cost_usd, 6), devices LIMIT 1",
)
def cheapest_devices(spark, sf_dir) -> DataFrame:
    costs = capacity.cost_projection(capacity.mean_rates(runs(spark, sf_dir)))
    return _rounded(capacity.cheapest_devices(costs))


@query(
    "time_breakdown",
    f"""WITH {R}, T AS (SELECT busy_sec AS t FROM R ORDER BY num_requests DESC, run_label DESC LIMIT 1),
X AS (SELECT 'Model Loading' AS part, 15.0::DOUBLE AS seconds, t FROM T
  UNION ALL SELECT 'Inference', (t - 15.0) * 0.9, t FROM T
  UNION ALL SELECT 'I/O', (t - 15.0) * 0.1, t FROM T)
SELECT part, round(seconds, 6) AS seconds, round(seconds * 100 / t, 6) AS percent FROM X""",
)
def time_breakdown(spark, sf_dir) -> DataFrame:
    return _rounded(capacity.time_breakdown(runs(spark, sf_dir)))
