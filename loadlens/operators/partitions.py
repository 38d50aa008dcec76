"""How many tasks a scoring job gets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.joins import attach_groups
from loadlens.scratch import checkpointed

# Rows of one scoring task, and bytes where sizes are known.
ROWS_PER_TASK = 200
BYTES_PER_TASK = 16 << 20


def waves(rows: int, slots: int, rows_per_task: int = ROWS_PER_TASK, total_bytes: int = 0) -> int:
    """Tasks for ``rows`` rows on ``slots`` task slots: equal waves that keep every slot busy.

    There are as many waves as keep a task at ``rows_per_task`` rows or fewer, so neither a slot
    idles in the last one nor does a lost task cost much. Few rows get a task each. With the bytes of
    all rows a task's share of them is ``BYTES_PER_TASK`` or less too, as Python gets them at once.
    """
    by_bytes = -(-total_bytes // (slots * BYTES_PER_TASK))
    return max(1, min(rows, slots * max(-(-rows // (slots * rows_per_task)), by_bytes)))


def tasks_for(rows: Column, limit: int, rows_per_task: int = ROWS_PER_TASK) -> Column:
    """Tasks of ``rows_per_task`` rows for a column of row counts, 1 to ``limit``."""
    full = F.ceil(rows / F.lit(float(rows_per_task)))
    return F.greatest(F.lit(1), F.least(full, F.lit(limit))).cast("int")


def spread_for_scoring(df: DataFrame, tasks: int) -> DataFrame:
    """Round-robin repartition, so scoring time does not follow the input's file sizes."""
    return df.repartition(tasks)


def spread_by_bytes(df: DataFrame, size: str, tasks: int) -> DataFrame:
    """Repartition so that every task gets about as many bytes, by the column that says a row's size.

    The sizes are added up along the rows and the sum is cut at equal steps, so a task gets at most
    its share and one more row: twice the mean unless one row is larger. A huge file is thus alone or
    nearly, and thousands of small ones share a task. Sums run within the input's partitions, whose
    totals (one row a partition) are added up over all. Unknown and empty sizes count as one byte.
    """
    bytes_ = F.greatest(F.coalesce(F.col(size), F.lit(1)), F.lit(1)).cast("long")
    rows = df.withColumn("_mid", F.monotonically_increasing_id()).withColumn("_bytes", bytes_)
    rows = checkpointed(rows).withColumn("_part", F.shiftright("_mid", 33))
    upto = Window.partitionBy("_part").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.groupBy("_part").agg(F.sum("_bytes").alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = sums.select(  # one row a partition of the input
        "_part",
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
        F.sum("_sum").over(every).alias("_all"),
    )
    rows = rows.withColumn("_upto", F.sum("_bytes").over(upto))
    placed = attach_groups(rows, sums, ["_part"], known_small=True)
    start = (F.col("_before") + F.col("_upto") - F.col("_bytes")).cast("decimal(20,0)")
    task = F.floor(start * F.lit(tasks).cast("decimal(10,0)") / F.col("_all")).cast("int")
    return placed.repartitionById(tasks, F.least(task, F.lit(tasks - 1))).select(*df.columns)
