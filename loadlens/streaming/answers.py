"""Requests and predictions as two streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def match_answers(
    requests: DataFrame,
    predictions: DataFrame,
    within: str,
    sent: str = "ingest_ts",
    done: str = "timestamp",
    key: str = "request_id",
    delays: tuple[str, str] = ("10 minutes", "10 minutes"),
) -> DataFrame:
    """Every request with its prediction, if one was made ``within`` that time after it.

    An outer join on key and time of two streams, each with a watermark of its own. A request waits
    in the state until the watermarks have passed the end of its time, and then leaves without a
    prediction; a prediction waits for a late request no longer than that either. Both sides are
    spread by the key, which is nearly unique. Rows with a null key or time have no partner, and on a stream
    those without time never leave. Columns of the predictions other than the key follow those of the
    requests; clashing names get the ending ``_answer``.
    """
    left = requests.withWatermark(sent, delays[0])
    renamed = {c: f"{c}_answer" for c in predictions.columns if c in requests.columns and c != key}
    right = predictions.withColumnsRenamed(renamed)
    moment = renamed.get(done, done)
    right = right.withColumnRenamed(key, "_key").withWatermark(moment, delays[1])
    until = F.col(sent) + F.expr(f"INTERVAL {within}")
    met = (F.col(key) == F.col("_key")) & (F.col(moment) >= F.col(sent)) & (F.col(moment) <= until)
    return left.join(right, met, "left_outer").drop("_key")
