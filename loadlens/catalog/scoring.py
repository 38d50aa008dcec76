"""Scoring with a stand-in model. Wall-clock columns are left out, as no SQL can know them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.catalog.registry import query
from loadlens.catalog.views import P, predictions, table
from loadlens.operators import reports, scoring
from loadlens.operators.partitions import spread_by_bytes, spread_for_scoring


def double_value(model: float, rows: pd.DataFrame) -> list[str]:
    """Model times value, in hundredths; a row of type error fails its micro-batch."""
    if "error" in rows["kind"].tolist():
        raise ValueError("cannot read image")
    return [str(round(ms * 100) * int(model)) for ms in rows["inference_time_ms"].tolist()]


def no_model() -> float:
    raise RuntimeError("weights missing")


_KEPT = [
    "request_id",
    "file_path",
    "true_label",
    "report_text",
    "gpu_used",
    "error_message",
    "run_label",
]


def _scored(spark, sf_dir, init, micro_batch: int = 1, halve: bool = False) -> DataFrame:
    rows = predictions(spark, sf_dir).withColumn("kind", F.split("file_path", "/")[2])
    # Scoring is what takes time, so its tasks follow the rows and not the input's files.
    rows = spread_for_scoring(rows, spark.sparkContext.defaultParallelism)
    scorer = scoring.Scorer(double_value, init, micro_batch, device="cpu-test", halve=halve)
    return scoring.score(rows, scorer, ["inference_time_ms", "kind"], ["run_label"])


@query(
    "score_requests",
    f"""WITH {P}, K AS (SELECT *, file_path LIKE '%/error/%' AS bad FROM P)
SELECT request_id, file_path, true_label, run_label, 'cpu-test' AS gpu_used,
  CASE WHEN bad THEN '' ELSE CAST(CAST(round(inference_time_ms * 100) AS BIGINT) * 2 AS VARCHAR) END
    AS report_text,
  CASE WHEN bad THEN 'ValueError: cannot read image' END AS error_message,
  true AS waits_add_up FROM K""",
)
def score_requests(spark, sf_dir) -> DataFrame:
    out = _scored(spark, sf_dir, lambda: 2.0)
    gap = F.col("end_to_end_ms") - F.col("queue_wait_ms") - F.col("inference_time_ms")
    return out.select(*_KEPT, (F.abs(gap) < 1e-3).alias("waits_add_up"))


@query(
    "score_init_failure",
    f"""WITH {P} SELECT request_id, file_path, true_label, run_label, 'cpu-test' AS gpu_used,
  '' AS report_text, 'Model load failed: weights missing' AS error_message,
  0.0::DOUBLE AS inference_time_ms, 0.0::DOUBLE AS queue_wait_ms, 0.0::DOUBLE AS end_to_end_ms
FROM P""",
)
def score_init_failure(spark, sf_dir) -> DataFrame:
    out = _scored(spark, sf_dir, no_model)
    return out.select(*_KEPT, "inference_time_ms", "queue_wait_ms", "end_to_end_ms")


# Which rows share a micro-batch of four depends on how they meet in a task. Certain is that no row
# is lost and that every unreadable one carries the error.
@query(
    "score_micro_batches",
    f"""WITH {P} SELECT run_label, count(*) AS rows,
  count(*) FILTER (WHERE file_path LIKE '%/error/%') AS unreadable, true AS all_marked
FROM P GROUP BY run_label""",
)
def score_micro_batches(spark, sf_dir) -> DataFrame:
    bad = F.col("file_path").contains("/error/")
    marked = F.col("error_message") == "ValueError: cannot read image"
    return _scored(spark, sf_dir, lambda: 2.0, 4).groupBy("run_label").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(bad).alias("unreadable"),
        (F.count_if(bad & marked) == F.count_if(bad)).alias("all_marked"),
    )


# With halving, micro-batches of sixteen give what rows scored one by one give.
@query(
    "score_halved",
    f"""WITH {P}, K AS (SELECT *, file_path LIKE '%/error/%' AS bad FROM P)
SELECT request_id, CASE WHEN bad THEN '' ELSE CAST(CAST(round(inference_time_ms * 100) AS BIGINT) * 2 AS VARCHAR)
  END AS report_text, CASE WHEN bad THEN 'ValueError: cannot read image' END AS error_message FROM K""",
)
def score_halved(spark, sf_dir) -> DataFrame:
    return _scored(spark, sf_dir, lambda: 2.0, 16, True).select("request_id", "report_text", "error_message")


# 24 tasks: none has more bytes than its share and one file, which is twice the mean for most.
@query(
    "scoring_tasks_by_bytes",
    """WITH B AS (SELECT greatest(strlen(html), 1) * CASE WHEN page_id % 97 = 0 THEN 50 ELSE 1 END AS b FROM pages)
SELECT count(*) AS files, CAST(sum(b) AS BIGINT) AS bytes, true AS balanced, true AS in_few_tasks FROM B""",
)
def scoring_tasks_by_bytes(spark, sf_dir) -> DataFrame:
    times = F.when(F.col("page_id") % 97 == 0, 50).otherwise(1)
    listing = table(spark, sf_dir, "pages").select(
        "url", (F.greatest(F.octet_length("html"), F.lit(1)) * times).cast("bigint").alias("size")
    )
    dealt = spread_by_bytes(listing, "size", 24).withColumn("task", F.spark_partition_id())
    tasks = dealt.groupBy("task").agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"), F.max("size").alias("largest")
    )
    share = F.sum("bytes") / 24
    return tasks.agg(
        F.sum("files").alias("files"),
        F.sum("bytes").alias("bytes"),
        (F.max("bytes") <= share + F.max("largest")).alias("balanced"),
        ((F.count(F.lit(1)) <= 24) & (F.max("task") < 24)).alias("in_few_tasks"),
    )


def first_word_class(model, rows: pd.DataFrame) -> list[str]:
    """A class name from the row's own text."""
    return [f"{'Pneumonia' if 'e' in t[:1].lower() else 'Normal'}. {len(t)}" for t in rows["text"]]


@query(
    "score_classifier",
    """SELECT CAST(doc_id AS VARCHAR) AS request_id, CASE WHEN lower(text[1]) = 'e' THEN 'PNEUMONIA'
  ELSE 'NORMAL' END AS prediction, 'HIGH' AS confidence,
  concat(CASE WHEN lower(text[1]) = 'e' THEN 'Pneumonia' ELSE 'Normal' END, '. ', length(text))
    AS report_text FROM documents""",
)
def score_classifier(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("request_id"), F.col("source").alias("file_path"), "text"
    )
    out = scoring.score(docs, scoring.Scorer(first_word_class), ["text"])
    return reports.classify(out, "report_text").select(
        "request_id", "prediction", "confidence", "report_text"
    )
