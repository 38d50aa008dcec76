"""Windowed metrics of a prediction or request stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.functions.numbers import ratio, succeeded
from loadlens.streaming.requests import is_prepared


def _figures(latency: str, percentile: float | None) -> list[Column]:
    ok = succeeded()
    n = F.count(F.lit(1))
    out = [
        n.alias("arrivals"),
        F.count_if(~ok).alias("errors"),
        ratio(F.count_if(~ok) * 100.0, n).alias("error_pct"),
        F.avg(F.when(ok, F.col(latency))).alias("mean_ms"),
    ]
    if percentile is not None:
        mark = F.percentile_approx(F.when(ok, F.col(latency)), percentile)
        out.append(mark.alias(f"p{round(percentile * 100)}_ms"))
    return out


def windowed_metrics(
    pred: DataFrame,
    width: str,
    slide: str | None = None,
    ts: str = "ingest_ts",
    by: Sequence[str] = (),
    latency: str = "inference_time_ms",
    percentile: float | None = 0.95,
) -> DataFrame:
    """Arrivals, errors and latencies per tumbling or sliding window.

    ``pred`` carries a watermark where it is a stream. Sums are combined within a task before the
    shuffle, so a hot group costs one row per task and window.
    """
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    out = pred.groupBy(window.alias("_w"), *by).agg(*_figures(latency, percentile))
    names = [c for c in out.columns if c not in ("_w", *by)]
    return out.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *by, *names
    )


def session_metrics(
    pred: DataFrame,
    gap: str,
    by: Sequence[str],
    ts: str = "ingest_ts",
    latency: str = "inference_time_ms",
) -> DataFrame:
    """The same figures per burst of one key, bursts being separated by ``gap``.

    On a stream the session must be prepared (:func:`prepare_session`), so that a task merges the
    rows of a hot key into bursts before it sends them on.
    """
    if not by:
        raise ValueError("a session needs a key")
    if pred.isStreaming and not is_prepared(pred.sparkSession):
        raise RuntimeError("call prepare_session first: a hot key would gather all its rows")
    out = pred.groupBy(F.session_window(ts, gap).alias("_w"), *by).agg(*_figures(latency, None))
    names = [c for c in out.columns if c not in ("_w", *by)]
    return out.select(
        F.col("_w.start").alias("session_start"), F.col("_w.end").alias("session_end"), *by, *names
    )
