"""Rows of a report gallery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions import messages, numbers, paths, times
from loadlens.operators.reports import with_markup
from loadlens.operators.sampling import first_n


def gallery_rows(
    pred: DataFrame,
    n: int | None = 10,
    order: Sequence[str] = ("file_path",),
    content: str | None = None,
) -> DataFrame:
    """Display columns of scored rows; with ``n`` only the first few in ``order``.

    The cut comes first, so only shown rows are cleaned and only their bytes are encoded.
    """
    rows = first_n(pred, n, order) if n is not None else pred
    ms = F.coalesce(F.col("inference_time_ms"), F.lit(0.0))
    sec = ms / 1000.0
    shown = with_markup(rows, "report_text", "report_html")
    extra = [messages.embedded(content).alias("image_base64")] if content else []
    return shown.select(
        "file_path",
        paths.study_id("file_path").alias("study_id"),
        paths.case_id("file_path").alias("case_id"),
        times.long_date(F.coalesce(F.col("timestamp"), F.current_timestamp())).alias("report_date"),
        F.round(sec, 2).alias("latency_sec"),
        numbers.latency_class(ms).alias("latency_class"),
        F.round(numbers.rate_of(sec), 2).alias("throughput_per_sec"),
        paths.short_device(F.coalesce("gpu_used", F.lit("Unknown"))).alias("device"),
        "report_html",
        *extra,
    )
