"""The given tables seen as requests, predictions and runs, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadlens.functions.times import from_ntz
from loadlens.plans.runs import run_view


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_predictions(events: DataFrame) -> DataFrame:
    """Events as prediction rows. Only column expressions, so it works on streams as well."""
    wait = "CAST(event_id % 1000 AS DOUBLE)"
    start = "unix_micros(moment)"
    # Naive timestamps of the tables are UTC.
    return events.withColumn("moment", from_ntz("ts")).selectExpr(
        "concat('req_', lpad(CAST(event_id AS STRING), 8, '0')) AS request_id",
        "concat('file:/data/', event_type, '/img_', user_id, '.png') AS file_path",
        "CASE WHEN event_id % 97 <> 0 THEN event_type END AS true_label",
        "moment AS ingest_ts",
        f"timestamp_micros({start} + (event_id % 1000) * 1000) AS dequeue_ts",
        f"timestamp_micros({start} + CAST(round(({wait} + value) * 1000) AS BIGINT)) AS timestamp",
        "value AS inference_time_ms",
        f"{wait} AS queue_wait_ms",
        f"{wait} + value AS end_to_end_ms",
        "CAST(event_id % 4 + 1 AS INT) AS batch_size",
        "concat('gpu-', user_id % 4) AS gpu_used",
        "CASE WHEN event_type = 'error' THEN concat('ValueError: ', props) END AS error_message",
        "concat(event_type, ': ', props) AS report_text",
        "format_string('run_%03d', event_id % 6 + 1) AS run_label",
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_predictions(table(spark, sf_dir, "events"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_view(predictions(spark, sf_dir))


P = """P AS (
  SELECT concat('req_', lpad(CAST(event_id AS VARCHAR), 8, '0')) AS request_id,
         concat('file:/data/', event_type, '/img_', CAST(user_id AS VARCHAR), '.png') AS file_path,
         CASE WHEN event_id % 97 <> 0 THEN event_type END AS true_label,
         epoch_us(ts) AS ingest_us,
         epoch_us(ts) + CAST(event_id % 1000 AS BIGINT) * 1000 AS dequeue_us,
         epoch_us(ts) + CAST(round((event_id % 1000 + value) * 1000) AS BIGINT) AS done_us,
         value AS inference_time_ms,
         CAST(event_id % 1000 AS DOUBLE) AS queue_wait_ms,
         CAST(event_id % 1000 AS DOUBLE) + value AS end_to_end_ms,
         CAST(event_id % 4 + 1 AS INTEGER) AS batch_size,
         concat('gpu-', CAST(user_id % 4 AS VARCHAR)) AS gpu_used,
         CASE WHEN event_type = 'error' THEN concat('ValueError: ', props) END AS error_message,
         concat(event_type, ': ', props) AS report_text,
         concat('run_', lpad(CAST(event_id % 6 + 1 AS VARCHAR), 3, '0')) AS run_label
  FROM events)"""

R = (
    P
    + """,
R AS (
  SELECT run_label, count(*) AS num_requests, sum(inference_time_ms) / 1000 AS busy_sec,
         count(*) / (sum(inference_time_ms) / 1000) AS throughput_per_sec,
         avg(inference_time_ms) AS mean_ms, quantile_disc(inference_time_ms, 0.95) AS p95_ms
  FROM P WHERE error_message IS NULL GROUP BY run_label)"""
)
