"""Timelines and trends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.catalog.registry import query
from loadlens.catalog.views import P, predictions
from loadlens.operators import timeline, trend


@query(
    "timeline",
    f"""WITH {P} SELECT run_label, request_id, inference_time_ms, gpu_used,
  (done_us - min(done_us) OVER (PARTITION BY run_label)) / 1000000.0 AS elapsed_sec,
  round(avg(inference_time_ms) OVER (PARTITION BY run_label), 6) AS mean_latency_ms FROM P""",
)
def timeline_rows(spark, sf_dir) -> DataFrame:
    rows = predictions(spark, sf_dir).select(
        "run_label", "request_id", "inference_time_ms", "gpu_used", "timestamp"
    )
    out = timeline.timeline(rows).drop("timestamp")
    return out.withColumn("mean_latency_ms", F.round("mean_latency_ms", 6))


def _adaptive(runs: str, span: float) -> str:
    return f"""WITH {P}, Q AS (SELECT {runs} AS run, request_id, done_us, inference_time_ms FROM P),
S AS (SELECT *, min(done_us) OVER (PARTITION BY run) AS s, max(done_us) OVER (PARTITION BY run) AS e,
  round(avg(inference_time_ms) OVER (PARTITION BY run), 9) AS mean_latency_ms,
  row_number() OVER (PARTITION BY run ORDER BY done_us, request_id) AS rn FROM Q)
SELECT run, request_id, inference_time_ms, mean_latency_ms,
  CASE WHEN (e - s) / 1000000.0 < {span} THEN 'Image Number' ELSE 'Time Elapsed (sec)' END AS x_label,
  CASE WHEN (e - s) / 1000000.0 < {span} THEN CAST(rn AS DOUBLE)
       ELSE (done_us - s) / 1000000.0 END AS x FROM S"""


def _adaptive_rows(spark, sf_dir, run, span: float) -> DataFrame:
    rows = predictions(spark, sf_dir).withColumn("run", run)
    out = timeline.timeline_adaptive(rows, ["run"], min_span_sec=span)
    return out.withColumn("mean_latency_ms", F.round("mean_latency_ms", 9))


@query("timeline_adaptive", _adaptive("run_label", 1.0))
def timeline_adaptive(spark, sf_dir) -> DataFrame:
    return _adaptive_rows(spark, sf_dir, F.col("run_label"), 1.0)


# Runs of one device and hour are short enough that both ways of placing a row occur.
@query(
    "timeline_sequence",
    _adaptive("concat(gpu_used, '/', CAST(ingest_us // 3600000000 AS VARCHAR))", 3300.0),
)
def timeline_sequence(spark, sf_dir) -> DataFrame:
    hour = F.expr("CAST(unix_micros(ingest_ts) DIV 3600000000 AS STRING)")
    run = F.concat("gpu_used", F.lit("/"), hour)
    return _adaptive_rows(spark, sf_dir, run, 3300.0)


# The first run of each device has no times at all; its rows are placed by their number.
@query(
    "timeline_null_times",
    f"""WITH {P}, Q AS (SELECT *, run_label = 'run_001' AS blank FROM P),
S AS (SELECT *, min(done_us) OVER (PARTITION BY run_label) AS s,
  row_number() OVER (PARTITION BY run_label ORDER BY request_id) AS rn FROM Q)
SELECT run_label, request_id, CASE WHEN blank THEN 'Image Number' ELSE 'Time Elapsed (sec)' END AS x_label,
  CASE WHEN blank THEN CAST(rn AS DOUBLE) ELSE (done_us - s) / 1000000.0 END AS x FROM S""",
)
def timeline_null_times(spark, sf_dir) -> DataFrame:
    known = F.when(F.col("run_label") != "run_001", F.col("timestamp"))
    rows = predictions(spark, sf_dir).withColumn("timestamp", known)
    out = timeline.timeline_adaptive(rows, ["run_label"])
    return out.select("run_label", "request_id", "x_label", "x")


_PIXELS = 40

# The four corners of every pixel column, by windows over all rows.
@query(
    "plot_points",
    f"""WITH {P}, X AS (SELECT run_label, inference_time_ms AS y, done_us - min(done_us) OVER w AS x,
  max(done_us) OVER w - min(done_us) OVER w AS span FROM P WINDOW w AS (PARTITION BY run_label)),
C AS (SELECT *, CAST(CASE WHEN span > 0 THEN least(x * {_PIXELS} // span, {_PIXELS} - 1) ELSE 0 END AS INTEGER) AS pixel FROM X),
N AS (SELECT *, row_number() OVER (PARTITION BY run_label, pixel ORDER BY x, y) AS a,
  row_number() OVER (PARTITION BY run_label, pixel ORDER BY x DESC, y DESC) AS b,
  row_number() OVER (PARTITION BY run_label, pixel ORDER BY y, x) AS c,
  row_number() OVER (PARTITION BY run_label, pixel ORDER BY y DESC, x DESC) AS d FROM C)
SELECT run_label, pixel, point, x / 1000000.0 AS elapsed_sec, y AS inference_time_ms FROM (
  SELECT *, 'first' AS point FROM N WHERE a = 1 UNION ALL SELECT *, 'last' FROM N WHERE b = 1
  UNION ALL SELECT *, 'lowest' FROM N WHERE c = 1 UNION ALL SELECT *, 'highest' FROM N WHERE d = 1)""",
)
def plot_points(spark, sf_dir) -> DataFrame:
    rows = predictions(spark, sf_dir).select("run_label", "timestamp", "inference_time_ms")
    return timeline.plot_points(rows, width=_PIXELS)


_ELAPSED = f"""{P}, E AS (SELECT run_label, inference_time_ms AS y,
  (done_us - min(done_us) OVER (PARTITION BY run_label)) / 1000000.0 AS x FROM P)"""


@query(
    "latency_trend",
    f"WITH {_ELAPSED} SELECT run_label, round(regr_slope(y, x) * 1000000, 4) AS slope_per_million, "
    "round(regr_intercept(y, x), 5) AS intercept FROM E GROUP BY run_label",
)
def latency_trend(spark, sf_dir) -> DataFrame:
    rows = predictions(spark, sf_dir).select("run_label", "inference_time_ms", "timestamp")
    out = trend.linear_trend(
        timeline.timeline(rows), "elapsed_sec", "inference_time_ms", ["run_label"]
    )
    return out.select(
        "run_label",
        F.round(F.col("slope") * 1000000, 4).alias("slope_per_million"),
        F.round("intercept", 5).alias("intercept"),
    )


# Load and rate per day of the event stream: the run sizes the curve is fitted to.
_DAYS = f"""{P}, D AS (SELECT dequeue_us // 86400000000 AS day, count(*) AS x,
  count(*) / (sum(inference_time_ms) / 1000) AS y FROM P GROUP BY 1)"""

_QUADRATIC = f"""{_DAYS},
M AS (SELECT (max(x) + min(x)) / 2.0 AS mid, (max(x) - min(x)) / 2.0 AS half FROM D),
U AS (SELECT (x - mid) / half AS u, y, mid, half FROM D, M),
S AS (SELECT any_value(mid) AS mid, any_value(half) AS half, CAST(count(*) AS DOUBLE) AS s0,
  sum(u) AS s1, sum(u*u) AS s2, sum(u*u*u) AS s3, sum(u*u*u*u) AS s4,
  sum(y) AS t0, sum(u*y) AS t1, sum(u*u*y) AS t2 FROM U),
W AS (SELECT *, s4*(s2*s0 - s1*s1) - s3*(s3*s0 - s1*s2) + s2*(s3*s1 - s2*s2) AS d FROM S),
C AS (SELECT mid, half,
  (t2*(s2*s0 - s1*s1) - s3*(t1*s0 - s1*t0) + s2*(t1*s1 - s2*t0)) / d AS a,
  (s4*(t1*s0 - s1*t0) - t2*(s3*s0 - s1*s2) + s2*(s3*t0 - t1*s2)) / d AS b,
  (s4*(s2*t0 - t1*s1) - s3*(s3*t0 - t1*s2) + t2*(s3*s1 - s2*s2)) / d AS c FROM W)"""


def _daily(spark, sf_dir) -> DataFrame:
    day = F.expr("unix_micros(dequeue_ts) DIV 86400000000")
    rows = predictions(spark, sf_dir).groupBy(day.alias("day"))
    busy = F.sum("inference_time_ms") / 1000
    return rows.agg(F.count(F.lit(1)).alias("x"), (F.count(F.lit(1)) / busy).alias("y"))


@query(
    "throughput_quadratic",
    f"WITH {_QUADRATIC} SELECT mid, half, round(a, 6) AS a, round(b, 6) AS b, round(c, 6) AS c FROM C",
)
def throughput_quadratic(spark, sf_dir) -> DataFrame:
    fit = trend.quadratic_trend(_daily(spark, sf_dir), "x", "y")
    return fit.select("mid", "half", *[F.round(c, 6).alias(c) for c in "abc"])


@query(
    "throughput_curve",
    f"""WITH {_QUADRATIC}, G AS (SELECT CAST(i AS INTEGER) AS point, -1.0::DOUBLE + i * (2.0::DOUBLE / 99) AS u
  FROM (SELECT unnest(range(100)) AS i))
SELECT point, round(mid + u * half, 6) AS x, round(a*u*u + b*u + c, 6) AS y FROM G, C""",
)
def throughput_curve(spark, sf_dir) -> DataFrame:
    fit = trend.quadratic_trend(_daily(spark, sf_dir), "x", "y")
    points = trend.quadratic_points(fit)
    return points.select("point", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))
