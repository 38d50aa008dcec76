"""Cross-run comparison and capacity or cost projections over the run table.

Levels, sizes and device counts are short lists of settings, so pairing them with runs is an
``explode`` of a literal array, not a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.functions.numbers import SECONDS_PER_DAY, ratio

# Fixed values of the projections.
DEVICE_COUNTS = (1, 2, 4, 8, 16, 32, 64)
COMPARED_DEVICE_COUNTS = (1, 4, 16, 64)
DATASET_SIZES = (1_000, 10_000, 100_000, 1_000_000, 10_000_000)
BURST_LEVELS = (100, 1_000, 10_000)
REQUEST_SIZE = 4
EFFICIENCY = 0.95
USD_PER_DEVICE_HOUR = 2.50
COST_DATASET = 100_000
MODEL_LOAD_SEC = 15.0
COMPUTE_SHARE = 0.90


def _each(values: Sequence[int]) -> Column:
    return F.explode(F.array(*[F.lit(v).cast("long") for v in values]))


def burst_drain(
    runs: DataFrame,
    throughput: str = "throughput_per_sec",
    run: str = "run_label",
    levels: Sequence[int] = BURST_LEVELS,
    request_size: int = REQUEST_SIZE,
    unit: str = "images",
) -> DataFrame:
    """Time to work off bursts that arrive at once; runs without a positive rate are left out.

    With ``unit="requests"`` the measured rate counts requests, each of ``request_size`` images.
    """
    rate = F.col(throughput)
    rows = runs.filter(rate > 0).select(
        run, rate.alias("throughput_per_sec"), _each(levels).alias("concurrent_requests")
    )
    total = F.col("concurrent_requests") * F.lit(request_size)
    images = F.col("throughput_per_sec") * (request_size if unit == "requests" else 1)
    return rows.select(
        run,
        "concurrent_requests",
        F.lit(request_size).alias("request_size_images"),
        total.alias("total_images"),
        "throughput_per_sec",
        images.alias("images_per_sec"),
        (total / images).alias("time_to_clear_sec"),
        (total / images / 60.0).alias("time_to_clear_min"),
    )


def _of_first(runs: DataFrame, column: str, order: Sequence[str]) -> Column:
    """Value of the first run in ``order``, as a scalar; no window over the run table."""
    return runs.agg(F.min_by(column, F.struct(*order))).scalar()


def scaling_efficiency(
    runs: DataFrame,
    throughput: str = "throughput_per_sec",
    order: Sequence[str] = ("num_requests", "run_label"),
) -> DataFrame:
    """Throughput of each run relative to the first run."""
    speedup = ratio(F.col(throughput), _of_first(runs, throughput, order))
    return runs.select(
        *order, throughput, speedup.alias("speedup"), (speedup * 100).alias("efficiency_pct")
    )


def linear_projection(
    runs: DataFrame,
    seconds: str = "busy_sec",
    items: str = "num_requests",
    order: Sequence[str] = ("num_requests", "run_label"),
) -> DataFrame:
    """Actual minutes and the minutes expected at the first run's time per item."""
    per_item = ratio(_of_first(runs, seconds, order), _of_first(runs, items, order))
    return runs.select(
        *order,
        (F.col(seconds) / 60).alias("actual_min"),
        (F.col(items) * per_item / 60).alias("linear_min"),
    )


def daily_capacity(
    runs: DataFrame, throughput: str = "throughput_per_sec", run: str = "run_label"
) -> DataFrame:
    per_day = F.col(throughput) * SECONDS_PER_DAY
    return runs.select(
        run, per_day.alias("daily_capacity"), (per_day / 1000).alias("daily_capacity_k")
    )


def load_size_table(runs: DataFrame, items: str = "num_requests", run: str = "run_label"):
    """Throughput and latency by load size."""
    return runs.select(run, items, "throughput_per_sec", "mean_ms").orderBy(items, run)


def summary_table(
    runs: DataFrame,
    items: str = "num_images",
    seconds: str = "wall_time_sec",
    throughput: str = "wall_throughput_img_per_sec",
    run: str = "run_label",
) -> DataFrame:
    """The figures shown per run; capacity is cut to whole items."""
    return runs.select(
        run,
        items,
        F.round(F.col(seconds) / 60, 2).alias("minutes"),
        F.round(throughput, 3).alias("items_per_sec"),
        F.floor(F.col(throughput) * SECONDS_PER_DAY).cast("long").alias("items_per_day"),
        "success_count",
        "error_count",
    )


def mean_rates(
    runs: DataFrame, throughput: str = "throughput_per_sec", latency: str = "mean_ms"
) -> DataFrame:
    """One row: plain means over runs, the base of the device projections."""
    return runs.agg(F.avg(throughput).alias("rate"), F.avg(latency).alias("latency_ms"))


def device_projection(base: DataFrame, counts: Sequence[int] = DEVICE_COUNTS) -> DataFrame:
    """Rate and daily capacity for device counts, at 95 % and at ideal efficiency."""
    n, rate = F.col("devices"), F.col("rate")
    return base.select("rate", _each(counts).alias("devices")).select(
        "devices",
        (rate * n * EFFICIENCY).alias("projected_per_sec"),
        (rate * n).alias("ideal_per_sec"),
        (rate * n * EFFICIENCY * SECONDS_PER_DAY / 1000).alias("daily_capacity_k"),
    )


def hours_to_process(
    base: DataFrame,
    sizes: Sequence[int] = DATASET_SIZES,
    counts: Sequence[int] = COMPARED_DEVICE_COUNTS,
    limit_hours: float = 24.0,
) -> DataFrame:
    rows = base.select("rate", _each(sizes).alias("items"))
    rows = rows.select("rate", "items", _each(counts).alias("devices"))
    hours = F.col("items") / (F.col("rate") * F.col("devices") * EFFICIENCY) / 3600
    return rows.select("items", "devices", hours.alias("hours")).withColumn(
        "within_limit", F.col("hours") <= limit_hours
    )


def cost_projection(
    base: DataFrame,
    items: int = COST_DATASET,
    counts: Sequence[int] = DEVICE_COUNTS,
    usd_per_hour: float = USD_PER_DEVICE_HOUR,
) -> DataFrame:
    """Hours and cost of one dataset by device count, and the cost of a thousand items."""
    n = F.col("devices")
    effective = F.col("rate") * n * EFFICIENCY
    hours = F.lit(items) / effective / 3600
    return base.select("rate", _each(counts).alias("devices")).select(
        "devices",
        hours.alias("hours"),
        (hours * n * usd_per_hour).alias("cost_usd"),
        (F.lit(1.0) / effective / 3600 * n * usd_per_hour * 1000).alias("usd_per_1000"),
    )


def cheapest_devices(costs: DataFrame, digits: int = 6) -> DataFrame:
    """Device count of least cost; equal costs (to ``digits`` places) go to the fewest devices."""
    rank = F.struct(F.round("cost_usd", digits), "devices")
    return costs.agg(
        F.min_by("devices", rank).alias("devices"), F.min_by("cost_usd", rank).alias("cost_usd")
    )


def time_breakdown(
    runs: DataFrame,
    seconds: str = "busy_sec",
    order: Sequence[str] = ("num_requests", "run_label"),
    load_sec: float = MODEL_LOAD_SEC,
    compute_share: float = COMPUTE_SHARE,
) -> DataFrame:
    """Last run's time split into model load and fixed shares of the rest."""
    last = runs.agg(F.max_by(seconds, F.struct(*order)).alias("_total"))
    rest = F.col("_total") - load_sec
    parts = F.array(
        *[
            F.struct(F.lit(name).alias("part"), value.alias("seconds"))
            for name, value in (
                ("Model Loading", F.lit(load_sec)),
                ("Inference", rest * compute_share),
                ("I/O", rest * (1 - compute_share)),
            )
        ]
    )
    out = last.select("_total", F.explode(parts).alias("_p"))
    return out.select(
        "_p.part", "_p.seconds", ratio(F.col("_p.seconds") * 100, F.col("_total")).alias("percent")
    )
