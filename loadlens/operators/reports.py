"""Report texts as lines and as display markup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions import text


def report_lines(df: DataFrame, column: str = "report_text", keep: Sequence[str] = ()) -> DataFrame:
    """One row per line of the cleaned text: keep..., line_no from 0, kind, line."""
    lines = df.select(*keep, F.posexplode(text.classified_lines(column)).alias("line_no", "_l"))
    return lines.select(*keep, "line_no", "_l.kind", "_l.line")


def with_markup(df: DataFrame, column: str = "report_text", name: str = "report_html") -> DataFrame:
    """Add the cleaned report, with fixed texts for failed and for empty ones.

    Each stage is a column of its own, used more than once by the next: Spark then evaluates it
    once per row instead of writing it into every place of use.
    """
    t = F.col(column)
    failed = t.isNull() | (t == "") | (t == "Error")
    staged = df.withColumn("_kept", text.without_skipped(text.classified_lines(column)))
    staged = staged.withColumn("_body", text.report_markup(F.col("_kept")))
    made = (
        F.when(failed, F.lit(text.FAILED_HTML))
        .when(F.col("_body") == "", F.lit(text.EMPTY_HTML))
        .otherwise(F.col("_body"))
    )
    return staged.withColumn(name, made).drop("_kept", "_body")


def classify(df: DataFrame, column: str = "raw_text") -> DataFrame:
    """Add prediction and confidence read from a classifier's answer."""
    named = df.withColumn("_token", text.first_token(column))
    named = named.withColumn("_p", text.label_of("_token"))
    return named.select(*df.columns, "_p.prediction", "_p.confidence")
