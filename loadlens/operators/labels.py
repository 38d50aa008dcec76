"""Accuracy tables of a labelled prediction table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions.numbers import ratio
from loadlens.operators.metrics import share


def _correct(true: str, predicted: str):
    return F.count_if(F.col(true) == F.col(predicted))


def accuracy(df: DataFrame, true: str = "true_label", predicted: str = "predicted_label") -> DataFrame:
    hit = _correct(true, predicted)
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("total"), hit.alias("correct"), F.round(ratio(hit * 100.0, n), 2).alias("accuracy_pct")
    )


def per_class_accuracy(
    df: DataFrame, true: str = "true_label", predicted: str = "predicted_label"
) -> DataFrame:
    hit = _correct(true, predicted)
    n = F.count(F.lit(1))
    return df.groupBy(true).agg(
        n.alias("total"), hit.alias("correct"), F.round(ratio(hit * 100.0, n), 2).alias("accuracy")
    )


def confusion(
    df: DataFrame, true: str = "true_label", predicted: str = "predicted_label"
) -> DataFrame:
    return df.groupBy(true, predicted).agg(F.count(F.lit(1)).alias("count"))


def confusion_wide(
    df: DataFrame,
    classes: list[str],
    true: str = "true_label",
    predicted: str = "predicted_label",
) -> DataFrame:
    """One column per predicted class; the classes are named, so no extra job looks for them."""
    wide = confusion(df, true, predicted).groupBy(true).pivot(predicted, classes).sum("count")
    return wide.na.fill(0, classes)


def prediction_distribution(df: DataFrame, predicted: str = "predicted_label") -> DataFrame:
    return share(df, F.col(predicted), predicted)


def class_report(df: DataFrame, prediction: str = "prediction", error: str = "ERROR") -> DataFrame:
    """Errors and rows in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(prediction) == error).alias("total_errors"),
    )


def error_samples(
    df: DataFrame, order: str = "image_id", n: int = 5, prediction: str = "prediction"
) -> DataFrame:
    """The first few failed rows by id, to look at."""
    return df.filter(F.col(prediction) == "ERROR").orderBy(order).limit(n)
