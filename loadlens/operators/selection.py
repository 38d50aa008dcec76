"""Selection of the rows up to the n-th key of a table or group, before anything is sorted."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.joins import attach_groups, row_bytes
from loadlens.scratch import checkpointed

#: Keys of a group that a round samples on average, and bounds it takes from them.
SAMPLE, BOUNDS = 4096, 8
#: So many rows more than wanted may be left of a group.
SPARE = 50_000


def _bounds(keys: str, need: Column, rows: Column) -> Column:
    """Keys around the place in a sorted sample where the wanted one should be.

    Within three standard deviations of that place, so the range that holds the wanted key is as a
    rule one of those between the bounds. No key stands for the end of the range.
    """
    place = need * F.size(keys) / rows
    reach = 3 * F.sqrt(place) + 4
    half = (BOUNDS - 1) / 2
    steps = [F.greatest(F.floor(place + reach * (k - half) / half), F.lit(0)) for k in range(BOUNDS)]
    return F.array(*[F.get(F.col(keys), s.cast("int")) for s in steps])


def rows_up_to(df: DataFrame, n: int, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The rows of ``df`` that can be among the first ``n`` of their group in ``order``.

    Groups of at most ``n + SPARE`` rows come whole. Of a larger one the n-th key is enclosed in a
    range: a sample of the range's keys gives bounds, the rows between them are counted, and the part
    with the n-th key is the next range, a thousandth of the last or so. It ends with at most
    ``SPARE`` rows in the range, or when a round leaves it as it was, as all its keys are equal; a
    poor sample costs rows that come along, and never loses one. What is left is filtered where it is
    read: only counters, sampled keys and one range a group move. Each round reads the keys twice.
    Nulls come first in ``order``, NaN last.
    """
    keys = list(by) or ["_one"]  # a table without groups is one
    rows = df if by else df.withColumn("_one", F.lit(0))
    key = F.struct(*[F.col(c) for c in order])
    keyed = rows.select(*keys, key.alias("_key"))
    none = F.lit(None).cast(keyed.schema["_key"].dataType)
    sizes = checkpointed(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")))
    ranges = sizes.filter(F.col("_rows") > n + SPARE).select(
        *keys,
        "_rows",
        F.lit(n).cast("long").alias("_need"),
        none.alias("_low"),
        none.alias("_high"),
        F.lit(False).alias("_still"),
    )
    found: list[DataFrame] = []
    while True:
        ranges = checkpointed(ranges)
        going = ~F.col("_still") & (F.col("_rows") > SPARE)
        left, size = ranges.filter(going).agg(F.count(F.lit(1)), F.sum(row_bytes(ranges))).first()
        found.append(ranges.filter(~going).select(*keys, "_high"))
        if not left:
            break
        ranges = _narrowed(keyed, ranges.filter(going), size, keys)
    ends = reduce(DataFrame.unionByName, found)
    ends = ends.select(*[F.col(c).alias(f"_e_{c}") for c in keys], "_high")
    ends = sizes.join(ends, _matched(keys, "_e_"), "left").select(*keys, "_high")
    kept = attach_groups(rows, ends, keys, known_small=not by)
    return kept.filter(F.col("_high").isNull() | (key <= F.col("_high"))).select(*df.columns)


def _matched(keys: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(c).eqNullSafe(F.col(prefix + c)) for c in keys]


def _within(keyed: DataFrame, ranges: DataFrame, size: int, keys: Sequence[str]) -> DataFrame:
    """The keys of each range, from above its lower end to its upper end."""
    placed = attach_groups(keyed, ranges, keys, size=size)
    above = F.col("_low").isNull() | (F.col("_key") > F.col("_low"))
    return placed.filter(above & (F.col("_high").isNull() | (F.col("_key") <= F.col("_high"))))


def _narrowed(keyed: DataFrame, ranges: DataFrame, size: int, keys: list[str]) -> DataFrame:
    """The part of each range that the wanted key is in."""
    ends = ranges.select(*keys, "_low", "_high", "_rows")
    sampled = _within(keyed, ends, size, keys).filter(F.rand(7) * F.col("_rows") < SAMPLE)
    sampled = sampled.groupBy(*keys).agg(F.array_sort(F.collect_list("_key")).alias("_keys"))
    renamed = sampled.select(*[F.col(c).alias(f"_s_{c}") for c in keys], "_keys")
    empty = F.array().cast(sampled.schema["_keys"].dataType)
    joined = ranges.join(renamed, _matched(keys, "_s_"), "left")
    joined = joined.withColumn("_keys", F.coalesce("_keys", empty))
    place = _bounds("_keys", F.col("_need"), F.col("_rows"))
    bounds = checkpointed(joined.select(*ranges.columns, place.alias("_bounds")))
    (wide,) = bounds.agg(F.sum(row_bytes(bounds))).first()

    marks = [F.get("_bounds", F.lit(k)) for k in range(BOUNDS)]
    passed = [F.coalesce(F.col("_key") > m, F.lit(False)).cast("int") for m in marks]
    part = reduce(lambda a, b: a + b, passed)
    rows = _within(keyed, bounds.select(*keys, "_low", "_high", "_bounds"), wide, keys)
    counted = rows.groupBy(*keys, part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.withColumn("_upto", F.sum("_n").over(upto))  # BOUNDS + 1 rows a group
    counted = counted.select(*[F.col(c).alias(f"_c_{c}") for c in keys], "_part", "_n", "_upto")
    before = F.col("_upto") - F.col("_n")
    hit = [F.col("_need") <= F.col("_upto"), F.col("_need") > before]
    low = F.when(F.col("_part") > 0, F.get("_bounds", F.col("_part") - 1))
    high = F.coalesce(F.get("_bounds", F.col("_part")), F.col("_high"))
    same = (F.col("_n") == F.col("_rows")) & high.eqNullSafe(F.col("_high"))
    return bounds.join(counted, _matched(keys, "_c_") + hit).select(
        *keys,
        F.col("_n").alias("_rows"),
        (F.col("_need") - before).alias("_need"),
        F.coalesce(low, F.col("_low")).alias("_low"),
        high.alias("_high"),
        same.alias("_still"),
    )
