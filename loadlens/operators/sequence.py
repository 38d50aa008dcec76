"""Dense numbers in sort order, without one task seeing a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.joins import attach_groups
from loadlens.scratch import checkpointed

_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, position below


def dense_sequence(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    start: int = 1,
    name: str = "seq",
) -> DataFrame:
    """Number the rows of each group from ``start`` in ``order``, which should end in a unique key.

    One range sort on group and order spreads a hot group over many tasks. The sorted rows are
    kept once with their place (partition, position), so both readers below see the same places.
    Rows per (partition, group) then give each partition its offset: at most one small row per
    partition and group, and without groups one row a partition, which is broadcast. The kept rows are a checkpoint, which Spark drops once the result is no
    longer referred to.
    """
    by = list(by)
    placed = checkpointed(
        df.orderBy(*by, *order).withColumn("_mid", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_mid", _LOCAL_BITS).cast("int"))
    counts = placed.groupBy(*by, "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first")
    )
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *by, "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    numbered = attach_groups(placed, offsets, [*by, "_part"], known_small=not by)
    value = F.col("_mid") - F.col("_first") + F.col("_before") + F.lit(start)
    return numbered.select(*df.columns, value.cast("long").alias(name))
