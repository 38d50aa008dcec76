"""Which offsets of a topic were read: ranges, gaps and repeats, and where to go on."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Offsets of one topic partition that a task puts in order.
BLOCK = 1 << 20
PLACE = ["topic", "partition"]


def _islands(offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys..., first, last`` of runs of neighbouring offsets; ``offsets`` has each once.

    A run is found within blocks of offsets first, so a partition with most of the messages is put
    in order by many tasks; only the runs of the blocks, a few a block, are joined per partition.
    """
    block = F.expr(f"`offset` div {BLOCK}")
    within = Window.partitionBy(*keys, "_block").orderBy("offset")
    placed = offsets.withColumn("_block", block)
    placed = placed.withColumn("_run", F.col("offset") - F.row_number().over(within))
    runs = placed.groupBy(*keys, "_block", "_run").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last")
    )
    along = Window.partitionBy(*keys).orderBy("first")
    fresh = F.coalesce(F.col("first") > F.lag("last").over(along) + 1, F.lit(True))
    runs = runs.withColumn("_new", fresh.cast("int"))
    runs = runs.withColumn("_id", F.sum("_new").over(along))
    return runs.groupBy(*keys, "_id").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_id")


def _counted(messages: DataFrame) -> DataFrame:
    rows = messages.filter("`offset` IS NOT NULL").groupBy(*PLACE, "offset")
    return rows.agg(F.count(F.lit(1)).alias("times"))


def read_ranges(messages: DataFrame) -> DataFrame:
    """``topic, partition, first, last`` of all unbroken ranges that were read."""
    return _islands(_counted(messages), PLACE)


def repeated_ranges(messages: DataFrame) -> DataFrame:
    """``topic, partition, first, last, times`` of the ranges that were read more than once."""
    rows = _counted(messages).filter("times > 1")
    return _islands(rows, [*PLACE, "times"]).select(*PLACE, "first", "last", "times")


def missing_ranges(ranges: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """``topic, partition, first, last`` of what lies between the ranges.

    ``expected`` has ``topic, partition, start, end`` (exclusive) of what should have been read; with it the
    beginning and the end count too, and partitions of which nothing was read.
    """
    if expected is not None:
        edges = [F.struct((F.col("start") - 1).alias("first"), (F.col("start") - 1).alias("last")),
                 F.struct(F.col("end").alias("first"), F.col("end").alias("last"))]
        ranges = ranges.select(*PLACE, "first", "last").unionByName(
            expected.select(*PLACE, F.explode(F.array(*edges)).alias("e")).select(*PLACE, "e.*")
        )
    along = Window.partitionBy(*PLACE).orderBy("first", "last")
    upto = F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1))
    gaps = ranges.withColumn("_upto", upto).filter(F.col("first") > F.col("_upto") + 1)
    return gaps.select(*PLACE, (F.col("_upto") + 1).alias("first"), (F.col("first") - 1).alias("last"))


def resume_offsets(ranges: DataFrame, missing: DataFrame) -> DataFrame:
    """``topic, partition, next``: the first offset not read, which may be that of a gap."""
    ends = ranges.groupBy(*PLACE).agg((F.max("last") + 1).alias("next"))
    gaps = missing.groupBy(*PLACE).agg(F.min("first").alias("gap"))
    gaps = gaps.withColumnsRenamed({c: f"_{c}" for c in PLACE})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PLACE]
    both = ends.join(gaps, same, "full_outer")
    return both.select(
        *[F.coalesce(c, f"_{c}").alias(c) for c in PLACE], F.least("next", "gap").alias("next")
    )


def starting_offsets(resume: DataFrame) -> str:
    """The ``startingOffsets`` of a reader that goes on there. One entry a partition of the topics."""
    topics: dict[str, dict[str, int]] = {}
    for row in resume.orderBy(*PLACE).collect():
        topics.setdefault(row.topic, {})[str(row.partition)] = row.next
    return json.dumps(topics, separators=(",", ":"))


def beyond(messages: DataFrame, resume: DataFrame) -> DataFrame:
    """The messages that a reader still has to take: from ``next`` on, and of new partitions all."""
    marks = resume.withColumnsRenamed({c: f"_{c}" for c in PLACE})
    same = [messages[c].eqNullSafe(marks[f"_{c}"]) for c in PLACE]
    joined = messages.join(F.broadcast(marks), same, "left")  # one row a partition of a topic
    return joined.filter("next IS NULL OR `offset` >= next").select(*messages.columns)
