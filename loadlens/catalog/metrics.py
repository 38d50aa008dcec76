"""Latency, throughput, shares, text lengths and accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.catalog.registry import query
from loadlens.catalog.views import P, predictions, table
from loadlens.operators import labels, metrics, sketches
from loadlens.operators.quantiles import exact_percentiles
from loadlens.plans.runs import metric_bundle
from loadlens.scratch import scratch_path


def _stats(column: str, unit: str = "ms", percentiles=(50, 95, 99), digits: int = 2) -> str:
    parts = [f"round({f}({column}), {digits})" for f in ("avg", "min", "max")]
    parts += [f"round(quantile_disc({column}, {p / 100}), {digits})" for p in percentiles]
    names = ["mean", "min", "max", *[f"p{p}" for p in percentiles]]
    return ", ".join(
        f"CAST({e} AS DOUBLE) AS {n}_{unit}" for e, n in zip(parts, names, strict=True)
    )


def _latency(column: str, by: str = "") -> str:
    head, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return f"WITH {P} SELECT {head}{_stats(column)} FROM P WHERE error_message IS NULL{tail}"


@query("latency_stats", _latency("inference_time_ms"))
def latency_stats(spark, sf_dir) -> DataFrame:
    return metrics.latency_stats(predictions(spark, sf_dir))


_ODD_SQL = """CASE event_id % 97 WHEN 1 THEN CAST('nan' AS DOUBLE) WHEN 2 THEN CAST('inf' AS DOUBLE)
  WHEN 3 THEN CAST('-inf' AS DOUBLE) ELSE CASE WHEN event_id % 3 = 0 THEN 250.0 ELSE value END END"""


@query(
    "latency_stats_odd",
    f"""WITH O AS (SELECT event_type, {_ODD_SQL} AS v FROM events),
Q AS (SELECT event_type, unnest([0.005, 0.5, 0.95, 0.985, 0.99]) AS p, count(*) AS n FROM O GROUP BY 1),
K AS (SELECT event_type, v, row_number() OVER (PARTITION BY event_type ORDER BY v) AS k FROM O)
SELECT event_type, p, CASE WHEN isnan(v) THEN 'nan' WHEN isinf(v) THEN CASE WHEN v > 0 THEN 'inf' ELSE '-inf' END
  ELSE CAST(CAST(round(v * 100) AS BIGINT) AS VARCHAR) END AS cents
FROM Q JOIN K USING (event_type) WHERE k = greatest(1, CAST(ceil(round(p * 1000) * n / 1000) AS BIGINT))""",
)
def latency_stats_odd(spark, sf_dir) -> DataFrame:
    """Latencies with NaN, both infinities and one value that a third of the rows have."""
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(250.0)).otherwise(F.col("value"))
    kind = F.col("event_id") % 97
    odd = F.when(kind == 1, float("nan")).when(kind == 2, float("inf")).when(kind == 3, float("-inf"))
    rows = table(spark, sf_dir, "events").select("event_type", odd.otherwise(hot).alias("v"))
    probs = [0.005, 0.5, 0.95, 0.985, 0.99]
    found = exact_percentiles(rows, {"v": F.col("v")}, probs, ["event_type"], cell_rows=5)
    value = F.col("value")
    text = F.when(F.isnan(value), "nan").when(value == float("inf"), "inf").when(value == float("-inf"), "-inf")
    cents = F.round(value * 100).cast("long").cast("string")
    return found.select("event_type", "p", text.otherwise(cents).alias("cents"))


@query(
    "merged_latency_states",
    f"""WITH {P}, S AS (SELECT run_label, unnest(['end_to_end_ms', 'inference_time_ms']) AS metric,
  unnest([end_to_end_ms, inference_time_ms]) AS v FROM P)
SELECT run_label, metric, count(*) AS rows, round(avg(v), 6) AS mean, min(v) AS min, max(v) AS max,
  true AS p50, true AS p95, true AS p99 FROM S GROUP BY ALL""",
)
def merged_latency_states(spark, sf_dir) -> DataFrame:
    """States per run and day, stored, merged per run: exact figures, and percentiles whose rank in all
    rows is within the stated bound."""
    rows = predictions(spark, sf_dir).withColumn("day", F.to_date("ingest_ts"))
    columns = {c: F.col(c) for c in ("end_to_end_ms", "inference_time_ms")}
    path = scratch_path(spark, "states")
    sketches.latency_states(rows, columns, ["run_label", "day"]).write.parquet(path)
    merged = sketches.merged_states(spark.read.parquet(path), ["run_label"])
    found = sketches.state_stats(merged).withColumn("mean", F.round("mean", 6))
    long = rows.select(
        "run_label", F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), c.alias("v")) for n, c in columns.items()])).alias("x")
    ).select("run_label", "x.*")
    names = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    checks = rank_checks(long, found, ["run_label", "metric"], names, "v", round(1 / sketches.RANK_ERROR))
    return found.drop(*names).join(checks, ["run_label", "metric"])


@query("queue_wait_stats", _latency("queue_wait_ms"))
def queue_wait_stats(spark, sf_dir) -> DataFrame:
    return metrics.latency_stats(predictions(spark, sf_dir), "queue_wait_ms")


@query("end_to_end_stats", _latency("end_to_end_ms"))
def end_to_end_stats(spark, sf_dir) -> DataFrame:
    return metrics.latency_stats(predictions(spark, sf_dir), "end_to_end_ms")


@query("latency_stats_by_label", _latency("inference_time_ms", "true_label"))
def latency_stats_by_label(spark, sf_dir) -> DataFrame:
    return metrics.latency_stats(predictions(spark, sf_dir), by=["true_label"])


@query("end_to_end_stats_by_run", _latency("end_to_end_ms", "run_label"))
def end_to_end_stats_by_run(spark, sf_dir) -> DataFrame:
    return metrics.latency_stats(predictions(spark, sf_dir), "end_to_end_ms", ["run_label"])


@query(
    "latency_stats_sketch",
    f"""WITH {P} SELECT run_label, true AS p50_ms, true AS p95_ms, true AS p99_ms
FROM P WHERE error_message IS NULL GROUP BY run_label""",
)
def latency_stats_sketch(spark, sf_dir) -> DataFrame:
    """Whether each value of the sketch is of a rank within its stated bound."""
    rows = predictions(spark, sf_dir).filter("error_message IS NULL")
    found = metrics.latency_stats(rows, by=["run_label"], method="sketch", digits=None, accuracy=200)
    names = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
    return rank_checks(rows, found, ["run_label"], names, "inference_time_ms", 200)


def rank_checks(rows, found, by, names, value, accuracy) -> DataFrame:
    """Per group and percentile: some rank of the value lies within 1 / accuracy of the wanted."""
    marks = found.select(*by, *names)
    met = rows.select(*by, F.col(value).alias("_v")).join(marks, by)
    checks = []
    for name, p in names.items():
        below, upto = F.count_if(F.col("_v") < F.col(name)), F.count_if(F.col("_v") <= F.col(name))
        n = F.count("_v")
        slack = n / F.lit(accuracy) + 1
        near = (below + 1 <= n * p + slack) & (upto >= n * p - slack) & (upto > below)
        checks.append(near.alias(name))
    return met.groupBy(*by).agg(*checks)


@query(
    "price_percentiles_by_flag",
    "SELECT l_returnflag, l_linestatus, "
    + _stats("l_extendedprice", "usd")
    + " FROM lineitem GROUP BY l_returnflag, l_linestatus",
)
def price_percentiles_by_flag(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    return metrics.value_stats(
        rows, F.col("l_extendedprice"), ["l_returnflag", "l_linestatus"], unit="usd"
    )


@query(
    "latency_by_user",
    f"WITH {P}, U AS (SELECT *, split_part(file_path, '_', 2) AS event_user FROM P) "
    f"SELECT event_user, {_stats('inference_time_ms', digits=9)} FROM U WHERE error_message IS NULL "
    "GROUP BY event_user",
)
def latency_by_user(spark, sf_dir) -> DataFrame:
    rows = predictions(spark, sf_dir).withColumn("event_user", F.split("file_path", "_")[1])
    return metrics.latency_stats(rows, by=["event_user"], digits=9)


# The way for large data, whatever the size.
@query("latency_stats_at_scale", _latency("inference_time_ms", "true_label"))
def latency_stats_at_scale(spark, sf_dir) -> DataFrame:
    return metrics.latency_stats(predictions(spark, sf_dir), by=["true_label"])


_THROUGHPUT = """count(*) AS total_requests, count(DISTINCT gpu_used) AS num_gpus,
  round(sum(inference_time_ms) / 1000, 2) AS summed_inference_time_sec,
  round(count(*) / nullif(sum(inference_time_ms) / 1000, 0), 2) AS throughput_req_per_sec"""


@query("throughput", f"WITH {P} SELECT {_THROUGHPUT} FROM P WHERE error_message IS NULL")
def throughput(spark, sf_dir) -> DataFrame:
    return metrics.throughput(predictions(spark, sf_dir))


@query(
    "throughput_by_device",
    f"WITH {P} SELECT gpu_used, {_THROUGHPUT} FROM P WHERE error_message IS NULL GROUP BY gpu_used",
)
def throughput_by_device(spark, sf_dir) -> DataFrame:
    return metrics.throughput(predictions(spark, sf_dir), ["gpu_used"])


_STATUS = "CASE WHEN error_message IS NULL THEN 'Success' ELSE 'Error' END"


def _share(key: str, name: str, source: str = "P", where: str = "") -> str:
    return (
        f"SELECT {key} AS {name}, count(*) AS count, "
        f"round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percentage "
        f"FROM {source} {where} GROUP BY 1"
    )


@query("status_share", f"WITH {P} {_share(_STATUS, 'status')}")
def status_share(spark, sf_dir) -> DataFrame:
    return metrics.status_share(predictions(spark, sf_dir))


@query(
    "status_share_by_run",
    f"WITH {P} SELECT run_label, {_STATUS} AS status, count(*) AS count, "
    "round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY run_label), 2) AS percentage "
    "FROM P GROUP BY 1, 2",
)
def status_share_by_run(spark, sf_dir) -> DataFrame:
    return metrics.status_share(predictions(spark, sf_dir), ["run_label"])


@query("label_share", f"WITH {P} {_share('true_label', 'true_label')}")
def label_share(spark, sf_dir) -> DataFrame:
    return metrics.share(predictions(spark, sf_dir), F.col("true_label"), "true_label")


@query(
    "device_share",
    f"WITH {P} {_share('gpu_used', 'gpu_used', where='WHERE gpu_used IS NOT NULL')}",
)
def device_share(spark, sf_dir) -> DataFrame:
    return metrics.device_share(predictions(spark, sf_dir))


@query(
    "status_totals",
    f"WITH {P} SELECT run_label, count(*) FILTER (WHERE error_message IS NULL) AS success_count, "
    "count(*) FILTER (WHERE error_message IS NOT NULL) AS error_count, "
    "round(count(*) FILTER (WHERE error_message IS NULL) * 100.0 / count(*), 6) "
    "AS success_rate_pct FROM P GROUP BY run_label",
)
def status_totals(spark, sf_dir) -> DataFrame:
    out = metrics.status_totals(predictions(spark, sf_dir), ["run_label"])
    return out.withColumn("success_rate_pct", F.round("success_rate_pct", 6))


@query(
    "text_length_stats",
    f"SELECT {_stats('length(text)', 'chars', (50, 95))} FROM documents",
)
def text_length_stats(spark, sf_dir) -> DataFrame:
    return metrics.text_length_stats(table(spark, sf_dir, "documents"), "text", error=None)


@query(
    "text_length_by_lang",
    f"SELECT lang, {_stats('length(text)', 'chars', (50, 95))} FROM documents GROUP BY lang",
)
def text_length_by_lang(spark, sf_dir) -> DataFrame:
    return metrics.text_length_stats(table(spark, sf_dir, "documents"), "text", ["lang"], error=None)


def _histogram(value: str, source: str) -> str:
    return f"""WITH {P}, V AS (SELECT CAST({value} AS DOUBLE) AS v FROM {source}),
E AS (SELECT min(v) AS lo, (max(v) - min(v)) / 30.0 AS w FROM V),
C AS (SELECT least(CAST(floor((v - lo) / w) AS INTEGER), 29) AS bin, count(*) AS n
      FROM V, E GROUP BY 1)
SELECT CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * w, 6) AS bin_start,
       round(lo + (g.bin + 1) * w, 6) AS bin_end, coalesce(n, 0) AS count
FROM (SELECT unnest(range(30)) AS bin) g CROSS JOIN E LEFT JOIN C ON C.bin = g.bin"""


def _edges(df: DataFrame) -> DataFrame:
    return df.withColumn("bin_start", F.round("bin_start", 6)).withColumn(
        "bin_end", F.round("bin_end", 6)
    )


@query("text_length_histogram", _histogram("length(text)", "documents"))
def text_length_histogram(spark, sf_dir) -> DataFrame:
    return _edges(metrics.histogram(table(spark, sf_dir, "documents"), F.length("text")))


@query(
    "latency_histogram",
    _histogram("inference_time_ms", "P WHERE error_message IS NULL"),
)
def latency_histogram(spark, sf_dir) -> DataFrame:
    rows = predictions(spark, sf_dir).filter(F.col("error_message").isNull())
    return _edges(metrics.histogram(rows, F.col("inference_time_ms")))


@query(
    "latency_spread",
    f"WITH {P} SELECT run_label, round(avg(inference_time_ms), 6) AS mean, "
    "min(inference_time_ms) AS min, max(inference_time_ms) AS max, "
    "round(stddev_samp(inference_time_ms), 6) AS std FROM P GROUP BY run_label",
)
def latency_spread(spark, sf_dir) -> DataFrame:
    out = metrics.spread(predictions(spark, sf_dir), by=["run_label"])
    return out.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


@query(
    "class_counts",
    f"WITH {P} SELECT CASE WHEN grouping(true_label) = 1 THEN 'TOTAL' ELSE true_label END "
    "AS true_label, count(*) AS count FROM P GROUP BY ROLLUP (true_label)",
)
def class_counts(spark, sf_dir) -> DataFrame:
    return metrics.class_counts(predictions(spark, sf_dir))


@query(
    "device_count",
    f"WITH {P} SELECT run_label, count(DISTINCT gpu_used) AS devices, "
    "count(DISTINCT gpu_used) > 1 AS by_device FROM P GROUP BY run_label",
)
def device_count(spark, sf_dir) -> DataFrame:
    devices = F.count_distinct("gpu_used")
    rows = predictions(spark, sf_dir).groupBy("run_label")
    return rows.agg(devices.alias("devices"), (devices > 1).alias("by_device"))


@query(
    "percentile_long",
    f"WITH {P}, S AS (SELECT {_stats('end_to_end_ms')} FROM P WHERE error_message IS NULL) "
    "SELECT 'Mean' AS metric, mean_ms AS value FROM S UNION ALL SELECT 'P50', p50_ms FROM S "
    "UNION ALL SELECT 'P95', p95_ms FROM S UNION ALL SELECT 'P99', p99_ms FROM S",
)
def percentile_long(spark, sf_dir) -> DataFrame:
    return metrics.bar_values(metrics.latency_stats(predictions(spark, sf_dir), "end_to_end_ms"))


def _bundle_sql() -> str:
    ok = "error_message IS NULL"
    cells = []
    for table_name, column, percentiles in (
        ("queue_wait_stats", "queue_wait_ms", (50, 95, 99)),
        ("inference_latency_stats", "inference_time_ms", (50, 95, 99)),
        ("end_to_end_stats", "end_to_end_ms", (50, 95, 99)),
        ("report_length_statistics", "length(report_text)", (50, 95)),
    ):
        for f, m in (("avg", "mean"), ("min", "min"), ("max", "max")):
            cells.append((table_name, m, f"{f}({column}) FILTER (WHERE {ok})"))
        for p in percentiles:
            cells.append(
                (table_name, f"p{p}", f"quantile_disc({column}, {p / 100}) FILTER (WHERE {ok})")
            )
    n, good = "count(*)", f"count(*) FILTER (WHERE {ok})"
    busy = f"(sum(inference_time_ms) FILTER (WHERE {ok}) / 1000)"
    cells += [
        ("throughput_metrics", "total_requests", good),
        ("throughput_metrics", "num_gpus", f"count(DISTINCT gpu_used) FILTER (WHERE {ok})"),
        ("throughput_metrics", "summed_inference_time_sec", busy),
        ("throughput_metrics", "throughput_req_per_sec", f"{good} / {busy}"),
        ("error_statistics", "success_count", good),
        ("error_statistics", "error_count", f"{n} - {good}"),
        ("error_statistics", "success_pct", f"{good} * 100.0 / {n}"),
        ("error_statistics", "error_pct", f"({n} - {good}) * 100.0 / {n}"),
    ]
    parts = [
        f"SELECT run_label, '{t}' AS metric_table, '{m}' AS metric, "
        f"round(CAST({e} AS DOUBLE), 2) AS value FROM P GROUP BY run_label"
        for t, m, e in cells
    ]
    return f"WITH {P} " + " UNION ALL ".join(parts)


@query("metric_bundle", _bundle_sql())
def bundle(spark, sf_dir) -> DataFrame:
    return metric_bundle(predictions(spark, sf_dir))


# Labels seen as a classifier's output: quality is the truth, not toxic the prediction.
_LABELLED = """L AS (SELECT CASE WHEN quality = 1 THEN 'NORMAL' ELSE 'PNEUMONIA' END AS true_label,
  CASE WHEN toxic = 0 THEN 'NORMAL' ELSE 'PNEUMONIA' END AS predicted_label FROM labels)"""


def _labelled(spark, sf_dir) -> DataFrame:
    def name(column: str, value: int):
        return F.when(F.col(column) == value, "NORMAL").otherwise("PNEUMONIA")

    return table(spark, sf_dir, "labels").select(
        name("quality", 1).alias("true_label"), name("toxic", 0).alias("predicted_label")
    )


_HITS = "count(*) FILTER (WHERE true_label = predicted_label)"


@query(
    "accuracy",
    f"WITH {_LABELLED} SELECT count(*) AS total, {_HITS} AS correct, "
    f"round({_HITS} * 100.0 / count(*), 2) AS accuracy_pct FROM L",
)
def accuracy(spark, sf_dir) -> DataFrame:
    return labels.accuracy(_labelled(spark, sf_dir))


@query(
    "per_class_accuracy",
    f"WITH {_LABELLED} SELECT true_label, count(*) AS total, {_HITS} AS correct, "
    f"round({_HITS} * 100.0 / count(*), 2) AS accuracy FROM L GROUP BY true_label",
)
def per_class_accuracy(spark, sf_dir) -> DataFrame:
    return labels.per_class_accuracy(_labelled(spark, sf_dir))


@query(
    "confusion",
    f"WITH {_LABELLED} SELECT true_label, predicted_label, count(*) AS count FROM L GROUP BY 1, 2",
)
def confusion(spark, sf_dir) -> DataFrame:
    return labels.confusion(_labelled(spark, sf_dir))


@query(
    "confusion_wide",
    f"WITH {_LABELLED} SELECT true_label, "
    "count(*) FILTER (WHERE predicted_label = 'NORMAL') AS NORMAL, "
    "count(*) FILTER (WHERE predicted_label = 'PNEUMONIA') AS PNEUMONIA FROM L GROUP BY 1",
)
def confusion_wide(spark, sf_dir) -> DataFrame:
    return labels.confusion_wide(_labelled(spark, sf_dir), ["NORMAL", "PNEUMONIA"])


@query(
    "prediction_distribution",
    f"WITH {_LABELLED} {_share('predicted_label', 'predicted_label', 'L')}",
)
def prediction_distribution(spark, sf_dir) -> DataFrame:
    return labels.prediction_distribution(_labelled(spark, sf_dir))
