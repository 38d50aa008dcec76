"""The event table as a file stream, drained with the available-now trigger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.catalog.metrics import rank_checks
from loadlens.catalog.registry import query
from loadlens.catalog.requests import _asset_files
from loadlens.catalog.scoring import double_value
from loadlens.catalog.views import P, as_predictions, predictions, table
from loadlens.functions import times
from loadlens.operators import metrics
from loadlens.operators.scoring import Scorer
from loadlens.scratch import scratch_path
from loadlens.sinks.messages import as_messages
from loadlens.streaming import requests as stream_requests
from loadlens.streaming import answers, inflight, sinks, windows
from loadlens.streaming.scoring import score_stream

_DELAY = "10 minutes"
# In append mode a window leaves when the watermark has passed its end.
_CLOSED = "(SELECT max(ingest_us) FROM P) - 600000000"


def _stream(spark, sf_dir) -> DataFrame:
    stream_requests.prepare_session(spark)
    schema = table(spark, sf_dir, "events").schema
    return as_predictions(stream_requests.stream_parquet(spark, sf_dir, schema, "events.parquet"))


def _watermarked(spark, sf_dir) -> DataFrame:
    return _stream(spark, sf_dir).withWatermark("ingest_ts", _DELAY)


def _edges_us(df: DataFrame, *names: str) -> DataFrame:
    for name in names:
        df = df.withColumn(f"{name}_us", times.micros(name)).drop(name)
    return df


_FIGURES = """count(*) AS arrivals, count(error_message) AS errors,
  round(count(error_message) * 100.0 / count(*), 6) AS error_pct,
  round(avg(inference_time_ms) FILTER (WHERE error_message IS NULL), 6) AS mean_ms"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("error_pct", F.round("error_pct", 6)).withColumn(
        "mean_ms", F.round("mean_ms", 6)
    )


@query(
    "stream_windowed",
    f"""WITH {P} SELECT ingest_us // 3600000000 * 3600000000 AS window_start_us,
  ingest_us // 3600000000 * 3600000000 + 3600000000 AS window_end_us, run_label, {_FIGURES}
FROM P GROUP BY 1, 2, 3 HAVING ingest_us // 3600000000 * 3600000000 + 3600000000 <= {_CLOSED}""",
)
def stream_windowed(spark, sf_dir) -> DataFrame:
    rows = windows.windowed_metrics(
        _watermarked(spark, sf_dir), "1 hour", by=["run_label"], percentile=None
    )
    out = sinks.run_to_table(rows, "windowed")
    return _rounded(_edges_us(out, "window_start", "window_end"))


@query(
    "stream_sliding",
    f"""WITH {P}, B AS (SELECT *, ingest_us // 1800000000 * 1800000000 - k * 1800000000 AS s
  FROM P CROSS JOIN (SELECT unnest([0, 1])::BIGINT AS k))
SELECT s AS window_start_us, s + 3600000000 AS window_end_us, {_FIGURES}
FROM B GROUP BY s HAVING s + 3600000000 <= {_CLOSED}""",
)
def stream_sliding(spark, sf_dir) -> DataFrame:
    rows = windows.windowed_metrics(
        _watermarked(spark, sf_dir), "1 hour", "30 minutes", percentile=None
    )
    out = sinks.run_to_table(rows, "sliding")
    return _rounded(_edges_us(out, "window_start", "window_end"))


@query(
    "stream_sessions",
    f"""WITH {P}, G AS (SELECT *, CASE WHEN ingest_us - lag(ingest_us) OVER w < 1800000000 THEN 0
    ELSE 1 END AS fresh FROM P WINDOW w AS (PARTITION BY gpu_used ORDER BY ingest_us)),
N AS (SELECT *, sum(fresh) OVER (PARTITION BY gpu_used ORDER BY ingest_us) AS n FROM G)
SELECT gpu_used, min(ingest_us) AS session_start_us, max(ingest_us) + 1800000000 AS session_end_us,
  {_FIGURES} FROM N GROUP BY gpu_used, n HAVING max(ingest_us) + 1800000000 <= {_CLOSED}""",
)
def stream_sessions(spark, sf_dir) -> DataFrame:
    rows = windows.session_metrics(_watermarked(spark, sf_dir), "30 minutes", ["gpu_used"])
    out = sinks.run_to_table(rows, "sessions")
    return _rounded(_edges_us(out, "session_start", "session_end"))


@query(
    "stream_percentile",
    f"""WITH {P} SELECT ingest_us // 86400000000 * 86400000000 AS window_start_us, true AS p95_ms
FROM P GROUP BY 1 HAVING ingest_us // 86400000000 * 86400000000 + 86400000000 <= {_CLOSED}
  AND count(*) > count(error_message)""",
)
def stream_percentile(spark, sf_dir) -> DataFrame:
    """Whether the sketch's percentile of each closed day is of a rank within its stated bound."""
    rows = windows.windowed_metrics(_watermarked(spark, sf_dir), "1 day")
    found = _edges_us(sinks.run_to_table(rows, "percentile"), "window_start", "window_end")
    day = (times.micros("ingest_ts") / 86_400_000_000).cast("bigint") * 86_400_000_000
    sent = predictions(spark, sf_dir).filter("error_message IS NULL")
    sent = sent.withColumn("window_start_us", day)
    return rank_checks(
        sent, found, ["window_start_us"], {"p95_ms": 0.95}, "inference_time_ms", 10_000
    )


@query("stream_dedup", f"WITH {P} SELECT request_id, ingest_us FROM P")
def stream_dedup(spark, sf_dir) -> DataFrame:
    """Every request sent twice; one of each arrives."""
    sent = [_stream(spark, sf_dir).select("request_id", "ingest_ts") for _ in range(2)]
    rows = sent[0].unionByName(sent[1]).withWatermark("ingest_ts", _DELAY)
    out = sinks.run_to_table(stream_requests.distinct_stream(rows), "dedup")
    return out.select("request_id", times.micros("ingest_ts").alias("ingest_us"))


@query(
    "stream_decode",
    f"WITH {P} SELECT file_path, true_label, request_id, ingest_us FROM P",
)
def stream_decode(spark, sf_dir) -> DataFrame:
    rows = _stream(spark, sf_dir).select(
        "file_path", "true_label", "request_id", times.iso_text("ingest_ts").alias("ingest_ts")
    )
    decoded = stream_requests.stream_requests(as_messages(rows))
    out = sinks.run_to_table(decoded, "decode")
    return out.withColumn("ingest_us", times.micros("ingest_ts")).drop("ingest_ts")


@query(
    "stream_score",
    f"""WITH {P}, Q AS (SELECT *, CAST(regexp_extract(file_path, 'img_(\\d+)', 1) AS BIGINT) AS page
  FROM P)
SELECT request_id, page AS page_id, CASE WHEN true_label = 'error' THEN '' ELSE
  CAST(CAST(round(inference_time_ms * 100) AS BIGINT) * 3 AS VARCHAR) END AS report_text,
  CASE WHEN true_label = 'error' THEN 'ValueError: cannot read image' END AS error_message
FROM Q JOIN pages ON page_id = page""",
)
def stream_score(spark, sf_dir) -> DataFrame:
    page = F.regexp_extract("file_path", r"img_(\d+)", 1)
    rows = _stream(spark, sf_dir).select(
        "request_id",
        "ingest_ts",
        "inference_time_ms",
        F.coalesce("true_label", F.lit("none")).alias("kind"),
        F.concat(F.lit("/data//pages/"), page, F.lit(".html")).alias("file_path"),
        page.cast("bigint").alias("page_id"),
    )
    scorer = Scorer(double_value, lambda: 3.0)
    listing = _asset_files(spark, sf_dir).drop("content")
    out = score_stream(rows, listing, scorer, ["inference_time_ms", "kind"], ["page_id"], 4)
    return sinks.run_to_table(out, "score").select(
        "request_id", "page_id", "report_text", "error_message"
    )


@query(
    "stream_batch_metrics",
    f"""WITH {P} SELECT run_label, count(*) FILTER (WHERE error_message IS NULL) AS success_count,
  count(error_message) AS error_count FROM P GROUP BY run_label""",
)
def stream_batch_metrics(spark, sf_dir) -> DataFrame:
    """Status totals per micro-batch, added up afterwards."""
    root = scratch_path(spark, "stream-batches")
    started = sinks.metrics_per_batch(
        _stream(spark, sf_dir),
        lambda rows: metrics.status_totals(rows, ["run_label"]),
        f"{root}/table",
        f"{root}/progress",
    )
    started.awaitTermination()
    batches = spark.read.parquet(f"{root}/table")
    return batches.groupBy("run_label").agg(
        F.sum("success_count").alias("success_count"), F.sum("error_count").alias("error_count")
    )


# One request in thirteen is never answered, the others after up to two hours.
_ANSWER_SECONDS = "event_id % 1000 * 7 + 1"
_TIMEOUT, _TICK = 3600, 1800


def _sent_and_answered(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = _stream(spark, sf_dir)
    number = F.substring("request_id", 5, 20).cast("bigint")
    seconds = F.expr(_ANSWER_SECONDS.replace("event_id", "CAST(substr(request_id, 5) AS BIGINT)"))
    made = rows.filter(number % 13 != 0)
    made = made.withColumn("timestamp", F.col("ingest_ts") + F.make_dt_interval(secs=seconds))
    return rows, made


_SENT_SQL = f"""{P}, S AS (SELECT request_id, gpu_used AS device, ingest_us AS sent_us,
  CASE WHEN n % 13 <> 0 THEN ingest_us + ({_ANSWER_SECONDS.replace("event_id", "n")}) * 1000000 END AS done_us
  FROM (SELECT *, CAST(substr(request_id, 5) AS BIGINT) AS n FROM P)),
M AS (SELECT (greatest(max(sent_us), max(done_us)) - 600000000) // 1000 * 1000 AS mark FROM S),
E AS (SELECT *, coalesce(done_us <= sent_us + {_TIMEOUT}000000, false) AS answered,
  CASE WHEN done_us <= sent_us + {_TIMEOUT}000000 THEN done_us ELSE sent_us + {_TIMEOUT}000000 END AS end_us FROM S)"""


def _tracked(spark, sf_dir) -> DataFrame:
    events = inflight.request_events(*_sent_and_answered(spark, sf_dir))
    return sinks.run_to_table(inflight.track_requests(events, _TIMEOUT, _TICK, _DELAY), "tracked")


@query(
    "stream_ended_requests",
    f"""WITH {_SENT_SQL} SELECT device, request_id, sent_us, end_us,
  CASE WHEN answered THEN 'answered' ELSE 'timeout' END AS outcome
FROM E, M WHERE (end_us + {_TICK}000000 - 1) // {_TICK}000000 * {_TICK}000000 <= mark""",
)
def stream_ended_requests(spark, sf_dir) -> DataFrame:
    return inflight.ended(_tracked(spark, sf_dir))


@query(
    "stream_in_flight",
    f"""WITH {_SENT_SQL}, T AS (SELECT device, mark, unnest(range((sent_us + {_TICK}000000 - 1) // {_TICK}000000 * {_TICK}000000,
  end_us, {_TICK}000000)) AS tick_us FROM E, M)
SELECT device, tick_us, count(*) AS in_flight FROM T WHERE tick_us <= mark GROUP BY ALL""",
)
def stream_in_flight(spark, sf_dir) -> DataFrame:
    return inflight.levels(_tracked(spark, sf_dir))


@query(
    "stream_answers",
    f"""WITH {_SENT_SQL}, W AS (SELECT (least(max(sent_us), max(done_us)) - 600000000) // 1000 * 1000 AS mark FROM S)
SELECT request_id, sent_us, CASE WHEN answered THEN done_us - sent_us END AS answer_us
FROM E, W WHERE answered OR sent_us + {_TIMEOUT}000000 < mark""",
)
def stream_answers(spark, sf_dir) -> DataFrame:
    """Requests and their predictions, joined as two streams; those without one in time leave alone."""
    sent, made = _sent_and_answered(spark, sf_dir)
    found = answers.match_answers(
        sent.select("request_id", "ingest_ts"), made.select("request_id", "timestamp"), f"{_TIMEOUT} SECONDS"
    )
    out = sinks.run_to_table(found, "answers")
    sent_us, done_us = times.micros("ingest_ts"), times.micros("timestamp")
    return out.select("request_id", sent_us.alias("sent_us"), (done_us - sent_us).alias("answer_us"))
