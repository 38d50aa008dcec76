"""Metrics of the prediction table.

Every function takes ``by``: empty gives the figures of one run, ``["run_label"]`` those of all
runs in one job. Rows with an error count only towards the error share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.functions.numbers import ratio, rounded, status, succeeded
from loadlens.operators.quantiles import ACCURACY, grouped_with_percentiles

PERCENTILES = (0.5, 0.95, 0.99)


def _pct_name(p: float, unit: str) -> str:
    return f"p{round(p * 100):d}_{unit}"


def value_stats(
    df: DataFrame,
    value: Column,
    by: Sequence[str] = (),
    percentiles: Sequence[float] = PERCENTILES,
    unit: str = "ms",
    digits: int | None = 2,
    method: str = "exact",
    accuracy: int = ACCURACY,
) -> DataFrame:
    """mean, min, max and percentiles of ``value``; all NULL where nothing was measured."""
    by = list(by)
    aggs = [
        F.avg(value).alias(f"mean_{unit}"),
        F.min(value).alias(f"min_{unit}"),
        F.max(value).alias(f"max_{unit}"),
    ]
    names = {("v", p): _pct_name(p, unit) for p in percentiles}
    if method == "sketch":
        marks = F.percentile_approx(value, [float(p) for p in percentiles], accuracy)
        out = df.groupBy(*by).agg(*aggs, marks.alias("_pct"))
        for i, name in enumerate(names.values()):
            out = out.withColumn(name, F.get("_pct", F.lit(i)))
    elif method == "exact":
        out = grouped_with_percentiles(df, by, aggs, {"v": value}, names, accuracy)
    else:
        raise ValueError(f"unknown method {method}")
    figures = [f"{x}_{unit}" for x in ("mean", "min", "max")] + list(names.values())
    return out.select(*by, *[rounded(F.col(c).cast("double"), digits).alias(c) for c in figures])


def latency_stats(
    pred: DataFrame, column: str = "inference_time_ms", by: Sequence[str] = (), **options
) -> DataFrame:
    return value_stats(pred.filter(succeeded()), F.col(column), by, **options)


def text_length_stats(
    pred: DataFrame,
    column: str = "report_text",
    by: Sequence[str] = (),
    error: str | None = "error_message",
    **options,
) -> DataFrame:
    rows = pred.filter(succeeded(error)) if error else pred
    return value_stats(rows, F.length(column), by, PERCENTILES[:2], "chars", **options)


def throughput(
    pred: DataFrame, by: Sequence[str] = (), digits: int | None = 2, device: str = "gpu_used"
) -> DataFrame:
    """Requests, distinct device names, busy seconds, and requests per busy second.

    The rate is serial-equivalent: time of all requests added up, not elapsed time.
    """
    busy = F.sum("inference_time_ms") / 1000
    return (
        pred.filter(succeeded())
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("total_requests"),
            F.count_distinct(device).alias("num_gpus"),
            rounded(busy, digits).alias("summed_inference_time_sec"),
            rounded(ratio(F.count(F.lit(1)), busy), digits).alias("throughput_req_per_sec"),
        )
    )


def share(
    df: DataFrame,
    key: Column,
    name: str,
    by: Sequence[str] = (),
    digits: int | None = 2,
    count: str = "count",
    percent: str = "percentage",
) -> DataFrame:
    """Rows per value of ``key`` and their percentage of all rows (of the group, if ``by``).

    The total comes from the counted groups, not from a window over them, so any number of
    distinct keys is fine; it is a scalar or a join on the groups.
    """
    by = list(by)
    counts = df.groupBy(*by, key.alias(name)).agg(F.count(F.lit(1)).alias(count))
    if not by:
        total = counts.agg(F.sum(count)).scalar()
        return counts.withColumn(percent, rounded(F.col(count) * 100.0 / total, digits))
    totals = counts.groupBy(*[F.col(k).alias(f"__t_{k}") for k in by]).agg(
        F.sum(count).alias("_total")
    )
    matched = [counts[k].eqNullSafe(totals[f"__t_{k}"]) for k in by]
    return counts.join(totals, matched).select(
        *by, name, count, rounded(F.col(count) * 100.0 / F.col("_total"), digits).alias(percent)
    )


def status_share(pred: DataFrame, by: Sequence[str] = (), **options) -> DataFrame:
    return share(pred, status(), "status", by, **options)


def status_totals(pred: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Success and error counts as columns, and the success rate in percent (NULL if no rows)."""
    ok = F.count_if(succeeded())
    return pred.groupBy(*by).agg(
        ok.alias("success_count"),
        F.count_if(~succeeded()).alias("error_count"),
        ratio(ok * 100.0, F.count(F.lit(1))).alias("success_rate_pct"),
    )


def device_share(pred: DataFrame, device: str = "gpu_used", **options) -> DataFrame:
    """Rows per device; rows without a device are left out, as in a value count."""
    return share(pred.filter(F.col(device).isNotNull()), F.col(device), device, **options)


def counts_desc(df: DataFrame, key: str, count: str = "count") -> DataFrame:
    """Rows per key, largest first, ties by key."""
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias(count))
    return out.orderBy(F.desc(count), F.asc_nulls_first(key))


def spread(
    df: DataFrame, column: str = "inference_time_ms", by: Sequence[str] = ()
) -> DataFrame:
    """mean, min, max and sample standard deviation."""
    return df.groupBy(*by).agg(
        F.avg(column).alias("mean"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
        F.stddev_samp(column).alias("std"),
    )


def class_counts(df: DataFrame, label: str = "true_label") -> DataFrame:
    """Rows per class and a TOTAL row."""
    rolled = df.rollup(label).agg(F.count(F.lit(1)).alias("count"), F.grouping(label).alias("_all"))
    name = F.when(F.col("_all") == 1, F.lit("TOTAL")).otherwise(F.col(label))
    return rolled.select(name.alias(label), "count")


def histogram(df: DataFrame, value: Column, bins: int = 30) -> DataFrame:
    """Equal-width bins from the smallest to the largest value, empty bins included.

    A single distinct value sits in the middle of a range of width one.
    """
    rows = df.select(value.cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    ends = rows.agg(F.min("_v").alias("_min"), F.max("_v").alias("_max")).filter(
        F.col("_min").isNotNull()
    )
    flat = F.col("_min") == F.col("_max")
    ends = ends.select(
        F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("_lo"),
        F.when(flat, F.lit(1.0)).otherwise(F.col("_max") - F.col("_min")).alias("_span"),
    ).withColumn("_width", F.col("_span") / F.lit(float(bins)))
    placed = rows.withColumn("_one", F.lit(0)).join(
        F.broadcast(ends.withColumn("_one", F.lit(0))), "_one"  # one row
    )
    index = F.least(F.floor((F.col("_v") - F.col("_lo")) / F.col("_width")), F.lit(bins - 1))
    counts = placed.groupBy(index.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    every = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.col("_lo") + F.col("bin") * F.col("_width")).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_width")).alias("bin_end"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("count"),
    )


def bar_values(stats: DataFrame, by: Sequence[str] = (), unit: str = "ms") -> DataFrame:
    """Mean and percentiles of a stats table as one row per figure."""
    pairs = [("Mean", f"mean_{unit}")] + [
        (f"P{round(p * 100):d}", _pct_name(p, unit)) for p in PERCENTILES
    ]
    parts = F.array(
        *[F.struct(F.lit(a).alias("metric"), F.col(b).alias("value")) for a, b in pairs]
    )
    return stats.select(*by, F.explode(parts).alias("_x")).select(*by, "_x.*")
