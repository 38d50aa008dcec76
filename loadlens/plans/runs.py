"""All figures of all load-test runs from the prediction table, in a fixed number of scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions.numbers import SECONDS_PER_DAY, ratio, succeeded
from loadlens.functions.times import elapsed_sec
from loadlens.operators.quantiles import grouped_with_percentiles
from loadlens.schemas import LATENCY_COLUMNS
from loadlens.scratch import checkpointed


def _short(column: str) -> str:
    return column.removesuffix("_ms").removesuffix("_time")


def run_summary(
    pred: DataFrame,
    by: Sequence[str] = ("run_label",),
    started: str = "dequeue_ts",
    finished: str = "timestamp",
) -> DataFrame:
    """One row per run: rows, wall time, wall throughput, mean and p95 of the three latencies.

    Wall time runs from the first start to the last finish found in the rows.
    """
    by = list(by)
    ok = succeeded()
    wall = elapsed_sec(F.min(started), F.max(finished))
    n = F.count(F.lit(1))
    aggs = [
        n.alias("num_requests"),
        F.count_if(ok).alias("success_count"),
        F.count_if(~ok).alias("error_count"),
        wall.alias("wall_time_sec"),
        ratio(n, wall).alias("wall_throughput_req_per_sec"),
        *[F.avg(F.when(ok, F.col(c))).alias(f"{_short(c)}_mean_ms") for c in LATENCY_COLUMNS],
    ]
    measured = {c: F.when(ok, F.col(c)) for c in LATENCY_COLUMNS}
    names = {(c, 0.95): f"{_short(c)}_p95_ms" for c in LATENCY_COLUMNS}
    return grouped_with_percentiles(pred, by, aggs, measured, names)


def dataset_summary(pred: DataFrame, **options) -> DataFrame:
    """The run summary in the columns of the summary file; reports carry no accuracy."""
    return run_summary(pred, **options).select(
        "run_label",
        F.col("num_requests").alias("num_images"),
        "wall_time_sec",
        F.col("wall_throughput_req_per_sec").alias("wall_throughput_img_per_sec"),
        F.col("inference_mean_ms").alias("mean_latency_ms"),
        F.col("inference_p95_ms").alias("p95_latency_ms"),
        "success_count",
        "error_count",
        F.lit(None).cast("double").alias("overall_accuracy_pct"),
    )


def demo_summary(
    pred: DataFrame,
    from_store: bool,
    from_topic: bool,
    by: Sequence[str] = ("run_label",),
    started: str = "dequeue_ts",
    finished: str = "timestamp",
) -> DataFrame:
    """One row per end-to-end run: what it read from, counts, latencies with p99, serial rate."""
    by, ok = list(by), succeeded()
    ms = F.when(ok, F.col("inference_time_ms"))
    aggs = [
        F.max(finished).alias("timestamp"),
        F.count(F.lit(1)).alias("total_images"),
        F.count_if(ok).alias("success_count"),
        F.count_if(~ok).alias("error_count"),
        F.avg(ms).alias("mean_latency_ms"),
        ratio(F.count_if(ok), F.sum(ms) / 1000).alias("throughput_img_per_sec"),
        elapsed_sec(F.min(started), F.max(finished)).alias("wall_time_sec"),
    ]
    names = {("v", 0.95): "p95_latency_ms", ("v", 0.99): "p99_latency_ms"}
    out = grouped_with_percentiles(pred, by, aggs, {"v": ms}, names)
    return out.select(
        *by,
        "timestamp",
        F.lit(from_store).alias("s3_enabled"),
        F.lit(from_topic).alias("kafka_enabled"),
        "total_images",
        "success_count",
        "error_count",
        "mean_latency_ms",
        "p95_latency_ms",
        "p99_latency_ms",
        "throughput_img_per_sec",
        "wall_time_sec",
    )


def run_view(pred: DataFrame, by: str = "run_label") -> DataFrame:
    """Busy-time view of runs used by the cross-run plans; successful rows only."""
    rows = pred.filter(succeeded())
    n = F.count(F.lit(1))
    busy = F.sum("inference_time_ms") / 1000
    aggs = [
        n.alias("num_requests"),
        busy.alias("busy_sec"),
        ratio(n, busy).alias("throughput_per_sec"),
        F.avg("inference_time_ms").alias("mean_ms"),
    ]
    value, names = {"v": F.col("inference_time_ms")}, {("v", 0.95): "p95_ms"}
    return grouped_with_percentiles(rows, [by], aggs, value, names)


def run_report(pred: DataFrame, by: Sequence[str] = ("run_label",), **options) -> DataFrame:
    """Every number of the run report: summary, success rate, serial rate and daily capacity."""
    return _report_of(run_summary(pred, by, **options))


def _report_of(summary: DataFrame) -> DataFrame:
    n_ok = F.col("success_count")
    serial = ratio(n_ok * 1000.0, F.col("inference_mean_ms") * n_ok)
    return summary.select(
        "*",
        ratio(n_ok * 100.0, F.col("num_requests")).alias("success_rate_pct"),
        serial.alias("serial_throughput_per_sec"),
        (serial * SECONDS_PER_DAY).alias("daily_capacity"),
    )


_TABLES = {
    "queue_wait_ms": "queue_wait_stats",
    "inference_time_ms": "inference_latency_stats",
    "end_to_end_ms": "end_to_end_stats",
    "report_chars": "report_length_statistics",
}


def _all_figures(
    pred: DataFrame, by: Sequence[str], started: str, finished: str
) -> tuple[DataFrame, list[tuple[str, str]]]:
    """One row per run with every figure as ``table__metric``, and the names in order.

    One aggregation for sums and shares, and one percentile pass over all measured columns.
    """
    ok = succeeded()
    measured = {c: F.when(ok, F.col(c)) for c in LATENCY_COLUMNS}
    measured["report_chars"] = F.when(ok, F.length("report_text").cast("double"))
    n, n_ok = F.count(F.lit(1)), F.count_if(ok)
    busy = F.sum(measured["inference_time_ms"]) / 1000
    aggs, placed = [], []

    def add(table: str, metric: str, column) -> None:
        aggs.append(column.cast("double").alias(f"{table}__{metric}"))
        placed.append((table, metric))

    for name, column in measured.items():
        for metric, f in (("mean", F.avg), ("min", F.min), ("max", F.max)):
            add(_TABLES[name], metric, f(column))
    add("throughput_metrics", "total_requests", n_ok)
    add("throughput_metrics", "num_gpus", F.count_distinct(F.when(ok, F.col("gpu_used"))))
    add("throughput_metrics", "summed_inference_time_sec", busy)
    add("throughput_metrics", "throughput_req_per_sec", ratio(n_ok, busy))
    add("error_statistics", "success_count", n_ok)
    add("error_statistics", "error_count", n - n_ok)
    add("error_statistics", "success_pct", ratio(n_ok * 100.0, n))
    add("error_statistics", "error_pct", ratio((n - n_ok) * 100.0, n))
    names = {
        (c, p): f"{_TABLES[c]}__p{round(p * 100)}"
        for c in measured
        for p in ((0.5, 0.95) if c == "report_chars" else (0.5, 0.95, 0.99))
    }
    placed += [tuple(n.split("__")) for n in names.values()]
    if started in pred.columns and finished in pred.columns:
        aggs.append(elapsed_sec(F.min(started), F.max(finished)).alias("wall_time_sec"))
    return grouped_with_percentiles(pred, by, aggs, measured, names), placed


def metric_bundle(pred: DataFrame, by: Sequence[str] = ("run_label",)) -> DataFrame:
    """All metric tables of all runs in long form: by..., metric_table, metric, value."""
    by = list(by)
    flat, placed = _all_figures(pred, by, "", "")
    cells = [
        F.struct(
            F.lit(t).alias("metric_table"),
            F.lit(m).alias("metric"),
            F.round(F.col(f"{t}__{m}"), 2).alias("value"),
        )
        for t, m in placed
    ]
    return flat.select(*by, F.explode(F.array(*cells)).alias("_c")).select(*by, "_c.*")


def load_test_tables(
    pred: DataFrame,
    by: Sequence[str] = ("run_label",),
    started: str = "dequeue_ts",
    finished: str = "timestamp",
) -> dict[str, DataFrame]:
    """The named metric tables and the run summary of all runs, all from one percentile pass.

    A run without a success has NULL figures rather than no row.
    """
    by = list(by)
    flat, _ = _all_figures(pred, by, started, finished)
    flat = checkpointed(flat)  # one row per run; every table below reads it

    def table(name: str, metrics: Sequence[str], unit: str = "") -> DataFrame:
        return flat.select(
            *by, *[F.round(f"{name}__{m}", 2).alias(f"{m}{unit}") for m in metrics]
        )

    plain, marks = ["mean", "min", "max"], ["p50", "p95", "p99"]
    out = {
        t: table(t, [*plain, *marks], "_ms") for c, t in _TABLES.items() if c != "report_chars"
    }
    out["report_length_statistics"] = table(
        "report_length_statistics", [*plain, *marks[:2]], "_chars"
    )
    counts = ["total_requests", "num_gpus"]
    rates = table(
        "throughput_metrics", [*counts, "summed_inference_time_sec", "throughput_req_per_sec"]
    )
    out["throughput_metrics"] = rates.withColumns({c: F.col(c).cast("long") for c in counts})
    shares = [
        F.struct(
            F.lit(status).alias("status"),
            F.col(f"error_statistics__{name}_count").cast("long").alias("count"),
            F.round(f"error_statistics__{name}_pct", 2).alias("percentage"),
        )
        for status, name in (("Success", "success"), ("Error", "error"))
    ]
    shown = flat.select(*by, F.explode(F.array(*shares)).alias("_s")).select(*by, "_s.*")
    out["error_statistics"] = shown.filter("count > 0")
    n_ok, n_bad = F.col("error_statistics__success_count"), F.col("error_statistics__error_count")
    summary = flat.select(
        *by,
        (n_ok + n_bad).cast("long").alias("num_requests"),
        n_ok.cast("long").alias("success_count"),
        n_bad.cast("long").alias("error_count"),
        "wall_time_sec",
        ratio(n_ok + n_bad, F.col("wall_time_sec")).alias("wall_throughput_req_per_sec"),
        *[F.col(f"{_TABLES[c]}__mean").alias(f"{_short(c)}_mean_ms") for c in LATENCY_COLUMNS],
        *[F.col(f"{_TABLES[c]}__p95").alias(f"{_short(c)}_p95_ms") for c in LATENCY_COLUMNS],
    )
    out["load_test_summary"] = _report_of(summary)
    return out
