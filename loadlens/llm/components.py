"""Connected components by repeated contraction towards randomly chosen neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import own_folder

#: Rows of links to a partition. A table this small is worked on in one task, without shuffles.
ROWS = 500_000


def packed(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` computed once, in as many partitions as its rows need, and its number of rows.

    Written as Parquet to the shared folder: a checkpoint would hand the optimiser what it knows of
    the columns from round to round, which grows beyond measure.
    """
    spark = df.sparkSession
    path = own_folder(spark, "links")
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    rows = kept.count()
    return kept.coalesce(max(1, -(-rows // ROWS))), rows


def connected_components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; the same root for all nodes of a component.

    Each round hooks every node to the neighbour with the smallest hash if that is smaller than its
    own, follows the hooks twice, and replaces the ends of all links by what they lead to. Links
    within a tree vanish. As the order by hash is random, a chain loses two thirds of its nodes in
    a round, whatever its numbers; a star is one node after two. The hash of one long is one to
    one, so there are no ties. The smallest neighbour is a minimum, combined before
    the shuffle; a root with many links is split by adaptive execution, as the other side has one
    row a node. Only the number of links left reaches the driver; as they get fewer, so do the
    partitions, down to one without any shuffle. No links give no rows; loops and repeated links do
    no harm. Nodes are longs.
    """
    links, left = packed(links.select("a", "b").filter("a <> b").distinct())
    ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    roots = None
    while left:
        both = links.select(F.inline(ends))
        hooks = both.groupBy(F.col("a").alias("node")).agg(
            F.min_by("b", F.xxhash64("b")).alias("to"), F.min(F.xxhash64("b")).alias("least")
        )
        smaller = F.col("least") < F.xxhash64("node")
        hooks = hooks.select("node", F.when(smaller, F.col("to")).otherwise(F.col("node")).alias("to"))
        for _jump in range(2):
            hooks, _ = packed(hooks)
            after = hooks.select(F.col("node").alias("to"), F.col("to").alias("next"))
            hooks = hooks.join(after, "to").select("node", F.col("next").alias("to"))
        hooks, _ = packed(hooks)
        if roots is None:
            roots = hooks.select("node", F.col("to").alias("root"))
        else:
            step = hooks.select(F.col("node").alias("root"), "to")
            roots, _ = packed(
                roots.join(step, "root", "left").select(
                    "node", F.coalesce("to", "root").alias("root")
                )
            )
        first = hooks.select(F.col("node").alias("a"), F.col("to").alias("x"))
        second = hooks.select(F.col("node").alias("b"), F.col("to").alias("y"))
        links, left = packed(
            links.join(first, "a")
            .join(second, "b")
            .filter("x <> y")
            .select(F.col("x").alias("a"), F.col("y").alias("b"))
            .distinct()
        )
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
