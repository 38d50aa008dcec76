"""Latency over time within a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions.times import elapsed_sec
from loadlens.joins import attach_groups
from loadlens.operators.quantiles import ordered_key
from loadlens.operators.sequence import dense_sequence


def run_bounds(df: DataFrame, ts: str, latency: str, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(
        F.min(ts).alias("_start"), F.max(ts).alias("_end"), F.avg(latency).alias("mean_latency_ms")
    )


def timeline(
    df: DataFrame,
    by: Sequence[str] = ("run_label",),
    ts: str = "timestamp",
    latency: str = "inference_time_ms",
) -> DataFrame:
    """Every row with the seconds since its run's first row and the run's mean latency.

    The per-run figures are aggregated and joined back; no window gathers a run in one task.
    """
    bounds = run_bounds(df, ts, latency, by).drop("_end")
    rows = attach_groups(df, bounds, by, known_small=not by)
    return rows.withColumn("elapsed_sec", elapsed_sec("_start", ts)).drop("_start")


def timeline_adaptive(
    df: DataFrame,
    by: Sequence[str] = ("run_label",),
    ts: str = "timestamp",
    key: str = "request_id",
    latency: str = "inference_time_ms",
    min_span_sec: float = 1.0,
) -> DataFrame:
    """Plot position: seconds since the start, or the row number where the whole run is shorter
    than ``min_span_sec`` or has no times at all. Only rows of such runs are sorted; rows without a
    time come first. In a run plotted by time they have no position."""
    by = list(by)
    bounds = run_bounds(df, ts, latency, by)
    rows = attach_groups(df.select(*by, key, ts, latency), bounds, by, known_small=not by)
    rows = rows.withColumn("_span", elapsed_sec("_start", "_end"))
    keep = [*by, key, latency, "mean_latency_ms"]
    by_time = F.coalesce(F.col("_span") >= min_span_sec, F.lit(False))
    long_runs = rows.filter(by_time).select(
        *keep, F.lit("Time Elapsed (sec)").alias("x_label"), elapsed_sec("_start", ts).alias("x")
    )
    short = rows.filter(~by_time).select(*keep, ts)
    numbered = dense_sequence(short, [ts, key], by).select(
        *keep, F.lit("Image Number").alias("x_label"), F.col("seq").cast("double").alias("x")
    )
    return long_runs.unionByName(numbered)


def plot_points(
    df: DataFrame,
    by: Sequence[str] = ("run_label",),
    ts: str = "timestamp",
    latency: str = "inference_time_ms",
    width: int = 1000,
) -> DataFrame:
    """The points that draw the same line as all rows on a plot ``width`` pixels wide.

    Of each pixel column of a run the first, last, lowest and highest row (M4): ``by..., pixel, point,
    elapsed_sec, latency``, at most ``4 * width`` rows a run whatever its size. All four come from
    one aggregate, combined within a task before the shuffle: ties are broken by one number made of
    both coordinates (equal times by the lower latency first, equal latencies by the earlier row for
    the lowest and by the later for the highest). Rows without time or latency are not drawn; NaN is
    above all numbers. A run of a single moment is one column.
    """
    by = list(by)
    rows = df.filter(F.col(ts).isNotNull() & F.col(latency).isNotNull())
    moment = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = rows.select(*by, moment.alias("_x"), F.col(latency).cast("double").alias("_y"))
    bounds = rows.groupBy(*by).agg(F.min("_x").alias("_first"), F.max("_x").alias("_end"))
    placed = attach_groups(rows, bounds, by, known_small=not by)
    x, span = F.col("_x") - F.col("_first"), F.col("_end") - F.col("_first")
    pixel = F.when(span > 0, F.least(F.floor(x * F.lit(width).cast("decimal(9,0)") / span), F.lit(width - 1)))
    placed = placed.select(*by, F.coalesce(pixel, F.lit(0)).cast("int").alias("pixel"), x.alias("_x"), "_y")
    # Whole numbers of 38 digits hold both coordinates; a time is below 2**53 microseconds.
    high = F.lit(1 << 53).cast("decimal(17,0)")
    far = F.lit(str(1 << 64)).cast("decimal(20,0)")
    key = ordered_key(F.col("_y")).cast("decimal(19,0)")
    by_time = (F.col("_x").cast("decimal(17,0)") * far + key).cast("decimal(38,0)")
    by_value = (key * high + F.col("_x").cast("decimal(17,0)")).cast("decimal(38,0)")
    marked = placed.withColumn("_t", by_time).withColumn("_v", by_value)
    corners = marked.groupBy(*by, "pixel").agg(
        F.min("_x").alias("x_first"), F.min_by("_y", "_t").alias("y_first"),
        F.max("_x").alias("x_last"), F.max_by("_y", "_t").alias("y_last"),
        F.min_by("_x", "_v").alias("x_lowest"), F.min("_y").alias("y_lowest"),
        F.max_by("_x", "_v").alias("x_highest"), F.max("_y").alias("y_highest"),
    )
    points = [
        F.struct(
            F.lit(name).alias("point"),
            (F.col(f"x_{name}") / 1_000_000).alias("elapsed_sec"),
            F.col(f"y_{name}").alias(latency),
        )
        for name in ("first", "last", "lowest", "highest")
    ]
    return corners.select(*by, "pixel", F.explode(F.array(*points)).alias("_p")).select(*by, "pixel", "_p.*")
