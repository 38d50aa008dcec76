"""Latency states that are stored beside the metric tables and merged without the predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a KLL sketch. The rank of a value it gives is within RANK_ERROR of the wanted one, as a
#: share of all rows, in 99 of 100 sketches; merged sketches keep the bound.
K = 1600
RANK_ERROR = 0.002


def latency_states(
    pred: DataFrame, columns: Mapping[str, Column], by: Sequence[str], k: int = K
) -> DataFrame:
    """``by..., metric, rows, total, low, high, state``: one small row per group and measure.

    Groups are runs, days or whatever is to be merged later. NULL and NaN are not measured; the
    infinities count as any other value. All parts are combined within a task before the shuffle.
    """
    values = [F.struct(F.lit(n).alias("metric"), c.cast("double").alias("v")) for n, c in columns.items()]
    rows = pred.select(*by, F.explode(F.array(*values)).alias("_x")).select(*by, "_x.*")
    rows = rows.filter(F.col("v").isNotNull() & ~F.isnan("v"))
    return rows.groupBy(*by, "metric").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("v").alias("total"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        F.kll_sketch_agg_double("v", F.lit(k)).alias("state"),
    )


def merged_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The states of coarser groups, from those of finer ones."""
    return states.groupBy(*by, "metric").agg(
        F.sum("rows").alias("rows"),
        F.sum("total").alias("total"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("state").alias("state"),
    )


def state_stats(states: DataFrame, percentiles: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Count, mean, extremes (all exact) and percentiles (within ``RANK_ERROR``) of each state."""
    marks = [
        F.kll_sketch_get_quantile_double("state", F.lit(float(p))).alias(f"p{round(p * 100)}")
        for p in percentiles
    ]
    plain = [c for c in states.columns if c not in ("total", "low", "high", "state")]
    return states.select(
        *plain,
        (F.col("total") / F.col("rows")).alias("mean"),
        F.col("low").alias("min"),
        F.col("high").alias("max"),
        *marks,
    )
