"""Streams against the same operators on the same rows as a batch."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from loadlens.operators import decode
from loadlens.streaming import requests as sreq
from loadlens.streaming import sinks, windows
from tests.helpers import MOMENT, rows

SCHEMA = (
    "request_id string, ingest_ts timestamp, inference_time_ms double, error_message string, dev string"
)


def folder(spark, tmp_path, batches):
    """One Parquet file per batch, arriving in order."""
    root = tmp_path / "in"
    for i, batch in enumerate(batches):
        df = spark.createDataFrame(batch, SCHEMA).coalesce(1)
        df.write.mode("append").parquet(str(root / f"b{i}"))
    return str(root / "*")


def row(i, minutes, error=None, dev="a"):
    return (f"r{i}", MOMENT + timedelta(minutes=minutes), float(i), error, dev)


def stream(spark, path, per_batch=1):
    schema = spark.createDataFrame([], SCHEMA).schema
    return sreq.stream_parquet(spark, path, schema, max_files=per_batch)


def test_windows_equal_batch(spark, tmp_path):
    data = [row(i, i * 0.7, "E: x" if i % 5 == 0 else None, "ab"[i % 2]) for i in range(200)]
    path = folder(spark, tmp_path, [data[:90], data[90:150], data[150:]])
    batch = windows.windowed_metrics(spark.read.schema(SCHEMA).parquet(path), "10 minutes", by=["dev"])
    live = stream(spark, path).withWatermark("ingest_ts", "5 minutes")
    got = sinks.run_to_table(windows.windowed_metrics(live, "10 minutes", by=["dev"]), "t")
    mark = MOMENT + timedelta(minutes=199 * 0.7 - 5)
    want = batch.filter(F.col("window_end") <= F.lit(mark))
    order = ["window_start", "dev"]
    assert rows(got, *order) == rows(want, *order) and got.count() > 10


def test_late_rows_leave(spark, tmp_path):
    # The row behind the watermark is judged by the watermark of the batch before its own.
    path = folder(
        spark, tmp_path, [[row(1, 0)], [row(3, 120)], [row(5, 121)], [row(2, 1)], [row(4, 240)]]
    )
    live = stream(spark, path).withWatermark("ingest_ts", "10 minutes")
    out = sinks.run_to_table(windows.windowed_metrics(live, "1 hour", percentile=None), "late")
    assert [r[2] for r in rows(out, "window_start")] == [1, 2]


def test_sessions(spark, tmp_path):
    data = [row(i, m) for i, m in enumerate([0, 3, 6, 30, 31, 200])]
    path = folder(spark, tmp_path, [data])
    sreq.prepare_session(spark)
    live = stream(spark, path).withWatermark("ingest_ts", "1 minute")
    got = rows(sinks.run_to_table(windows.session_metrics(live, "5 minutes", ["dev"]), "s"), "session_start")
    assert [r[3] for r in got] == [3, 2]


def test_copies_within_the_watermark_leave(spark, tmp_path):
    path = folder(spark, tmp_path, [[row(1, 0), row(1, 1), row(2, 2)], [row(1, 3), row(3, 4)]])
    live = stream(spark, path).withWatermark("ingest_ts", "10 minutes")
    got = sinks.run_to_table(sreq.distinct_stream(live), "d")
    assert sorted(r.request_id for r in got.collect()) == ["r1", "r2", "r3"]
    split = stream(spark, path).withWatermark("ingest_ts", "10 minutes")
    got = sinks.run_to_table(sreq.distinct_stream(split, within="inference_time_ms"), "d2")
    assert sorted(r.request_id for r in got.collect()) == ["r1", "r2", "r3"]


def test_options_are_known_to_spark(spark, tmp_path):
    path = folder(spark, tmp_path, [[row(1, 0), row(1, 1)], [row(2, 30)]])
    before = {k: spark.conf.get(k) for k in sreq.STREAM_OPTIONS}
    try:
        spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "false")
        live = stream(spark, path).withWatermark("ingest_ts", "1 minute")
        with pytest.raises(RuntimeError, match="prepare_session"):
            windows.session_metrics(live, "5 minutes", ["dev"])
        sreq.prepare_session(spark)
        out = sinks.run_to_table(windows.session_metrics(live, "5 minutes", ["dev"]), "o")
        assert [r[3] for r in rows(out)] == [2]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_decoding_equals_batch(spark, tmp_path):
    path = tmp_path / "m"
    texts = [
        '{"file_path":"a","request_id":"r1","ingest_ts":"2025-12-10T04:35:45Z"}',
        "not json",
        '{"file_path":"b","request_id":"r2","ingest_ts":"soon"}',
    ]
    df = spark.createDataFrame([(bytearray(t.encode()),) for t in texts], "value binary")
    df.write.parquet(str(path))
    live = sreq.stream_parquet(spark, str(path), df.schema)
    got = sinks.run_to_table(sreq.stream_requests(live), "m")
    assert rows(got) == rows(decode.decode_requests(df)) and got.count() == 1


def test_restart_continues(spark, tmp_path):
    """New input after a restart is added once; old input is not read again."""
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    path = folder(spark, tmp_path, [[row(1, 0), row(2, 1)]])
    sinks.to_parquet(stream(spark, path), out, progress).awaitTermination()
    sinks.to_parquet(stream(spark, path), out, progress).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    spark.createDataFrame([row(3, 2)], SCHEMA).write.parquet(str(tmp_path / "in" / "b9"))
    sinks.to_parquet(stream(spark, path), out, progress).awaitTermination()
    assert sorted(r.request_id for r in spark.read.parquet(out).collect()) == ["r1", "r2", "r3"]


def test_repeated_batch_is_not_counted_twice(spark, tmp_path):
    path = folder(spark, tmp_path, [[row(1, 0)], [row(2, 1), row(3, 2)]])
    out = str(tmp_path / "m")
    for progress in ("p1", "p2"):
        counted = sinks.metrics_per_batch(
            stream(spark, path),
            lambda df: df.agg(F.count(F.lit(1)).alias("n")),
            out,
            str(tmp_path / progress),
        )
        counted.awaitTermination()
    got = spark.read.parquet(out)
    assert got.agg(F.sum("n")).first()[0] == 3 and got.select("batch_id").distinct().count() == 2
