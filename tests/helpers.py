"""Small frames and plan inspection shared by the tests."""

from __future__ import annotations

from datetime import datetime

MOMENT = datetime(2025, 12, 10, 4, 35, 45, 410891)
PRED = (
    "request_id string, file_path string, true_label string, report_text string, "
    "queue_wait_ms double, inference_time_ms double, end_to_end_ms double, "
    "gpu_used string, error_message string, run_label string"
)


def pred_row(i, ms=None, error=None, run="run_001", label="NORMAL", wait=0.0, gpu="A100-80GB", text="ok"):
    ms = float(i) if ms is None else ms
    return (
        f"req_{i:08d}", f"/data/{label}/img_{i}.png", label, "" if error else text,
        float(wait), ms, wait + ms, gpu, error, run,
    )


def preds(spark, rows):
    return spark.createDataFrame(rows, PRED)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
