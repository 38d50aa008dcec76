"""Declared schemas of the request, prediction and summary tables.

Latencies are doubles and times are timestamps; the request message keeps its times as text
because that is what travels on the topic.
"""

from __future__ import annotations

from pyspark.sql import types as T

REQUEST_MESSAGE = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("true_label", T.StringType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("ingest_ts", T.StringType()),
    ]
)

PREDICTION = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("ingest_ts", T.TimestampType()),
        T.StructField("dequeue_ts", T.TimestampType()),
        T.StructField("queue_wait_ms", T.DoubleType()),
        T.StructField("true_label", T.StringType()),
        T.StructField("report_text", T.StringType()),
        T.StructField("inference_time_ms", T.DoubleType()),
        T.StructField("end_to_end_ms", T.DoubleType()),
        T.StructField("batch_size", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("gpu_used", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("s3_key", T.StringType()),
        T.StructField("s3_uri", T.StringType()),
        T.StructField("local_path", T.StringType()),
        T.StructField("label", T.StringType()),
    ]
)

RUN_SUMMARY = T.StructType(
    [
        T.StructField("run_label", T.StringType()),
        T.StructField("num_images", T.LongType()),
        T.StructField("wall_time_sec", T.DoubleType()),
        T.StructField("wall_throughput_img_per_sec", T.DoubleType()),
        T.StructField("mean_latency_ms", T.DoubleType()),
        T.StructField("p95_latency_ms", T.DoubleType()),
        T.StructField("success_count", T.LongType()),
        T.StructField("error_count", T.LongType()),
        T.StructField("overall_accuracy_pct", T.DoubleType()),
    ]
)

LATENCY_COLUMNS = ("queue_wait_ms", "inference_time_ms", "end_to_end_ms")
