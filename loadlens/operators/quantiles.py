"""Exact discrete percentiles per group, at any size and by one definition.

A percentile here is always a value of the data: the smallest one whose rank reaches ``p * n``.

The first scan computes the caller's aggregates and, with a sketch, a bracket around every wanted
rank. The second counts rows in cells of the brackets (a few thousand counters per group, combined
before the shuffle) and names the cell each rank falls in; the counts cover all rows, so the
answer is exact even where the sketch misses. The third counts the distinct values of those cells.
A cell that holds too many rows, because a bracket spans a gap of the data, is cut into cells again
first. So neither a hot group nor an odd distribution gathers rows in a task.

Cells are ranges of whole numbers that order as the doubles do (``ordered_key``), infinities and NaN
included: NaN is above all, as in SQL, and the zeros are one value. A cell of 64 bits falls apart into
``cells`` of them at a time, so with 1024 cells at most seven rounds lead to a single value.

What is kept between the scans has one row per group; it is checkpointed. The input is read once
per scan: write rows that are costly or not repeatable, such as scores, before measuring them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.joins import attach_groups, null_safe, row_bytes
from loadlens.scratch import checkpointed

ACCURACY = 10_000
CELLS = 1024
CELL_ROWS = 1_000_000  # rows of one cell whose distinct values one task may order
_FRACTION = 1 << 52  # of the bits of a double
_SMALLEST, _SMALLEST_NORMAL = 5e-324, 2.2250738585072014e-308
_SCALE = 1_000_000  # probabilities are read to six places, so ranks are whole-number arithmetic


def _rank(p: float, n: Column) -> Column:
    """Smallest rank that reaches ``p * n``, at least 1."""
    k = round(p * _SCALE)
    whole = F.floor(n / F.lit(_SCALE)).cast("long")
    rest = n - whole * F.lit(_SCALE)
    part = F.ceil((rest * F.lit(k)) / F.lit(_SCALE)).cast("long")
    return F.greatest(whole * F.lit(k) + part, F.lit(1).cast("long"))


def _long_form(df: DataFrame, columns: Mapping[str, Column], by: Sequence[str]) -> DataFrame:
    """One row per input row and measured column: by..., _m (its number), _v. NULLs have no rank."""
    values = [value.cast("double") for value in columns.values()]
    if len(values) == 1:
        out = df.select(*by, F.lit(0).alias("_m"), values[0].alias("_v"))
    else:
        out = df.select(*by, F.posexplode(F.array(*values)).alias("_m", "_v"))
    return out.filter(F.col("_v").isNotNull())


def _running(cells: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows up to and including each cell, within its group."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return cells.withColumn("_upto", F.sum("_n").over(w))


def _reached(ranked: DataFrame, rank: Column) -> DataFrame:
    return ranked.filter((rank <= F.col("_upto")) & (rank > F.col("_upto") - F.col("_n")))


def ordered_key(value: Column) -> Column:
    """A whole number for each double, in the order of the doubles: its bits, negated below zero.

    The bits come from the exponent and the fraction. The logarithm may be off by one near a power of
    two and is put right; scaling by powers of two is exact.
    """
    size = F.abs(value)
    guess = F.greatest(F.least(F.floor(F.log2(size)), F.lit(1023)), F.lit(-1022)).cast("int")
    scaled = size / F.pow(F.lit(2.0), guess)
    off = F.when(scaled >= 2, 1).when(scaled < 1, -1).otherwise(0)
    part = F.when(scaled >= 2, scaled / 2).when(scaled < 1, scaled * 2).otherwise(scaled)
    fraction = ((part - 1) * _FRACTION).cast("long")
    bits = (guess + off + 1023).cast("long") * F.lit(_FRACTION) + fraction
    bits = (
        F.when(F.isnan(value), F.lit(2047 * _FRACTION + 1))
        .when(size == float("inf"), F.lit(2047 * _FRACTION))
        .when(size < _SMALLEST_NORMAL, (size / _SMALLEST).cast("long"))
        .otherwise(bits)
    )
    return F.when(value < 0, -bits).otherwise(bits)


def _cells_of(key: Column, low: Column, high: Column, cells: int) -> Column:
    """The cell of a key between two others: the bits that remain if so many are shifted out that
    the ends are about ``cells`` apart. Ends that differ are in different cells."""
    half = F.shiftright(high, 1) - F.shiftright(low, 1)  # the whole difference may not fit a long
    wanted = max(2, cells.bit_length() - 1)
    shift = F.ceil(F.log2(half.cast("double") + 1)).cast("int") + 1 - wanted
    shift = F.greatest(shift, F.lit(0))
    return F.call_function("shiftright", key, shift) - F.call_function("shiftright", low, shift)


def _first_cells(
    rows: DataFrame,
    brackets: DataFrame,
    size: int,
    probs: Sequence[float],
    keys: Sequence[str],
    cells: int,
) -> DataFrame:
    """The cell of every wanted rank: keys..., _p, _need (rank within it), _n, _lo, _hi."""
    edges = [F.get("_cuts", F.lit(i)) for i in range(2 * len(probs))]
    # Zone 2i+1 is the closed bracket of probability i, even zones lie between brackets.
    placed = attach_groups(rows, brackets, keys, size=size)
    passed = [F.col("_v") >= e if i % 2 == 0 else F.col("_v") > e for i, e in enumerate(edges)]
    zone = reduce(lambda a, b: a + b, [x.cast("int") for x in passed])
    placed = placed.withColumn("_zone", zone)
    low, high = F.get("_cuts", F.col("_zone") - 1), F.get("_cuts", F.col("_zone"))
    inside = F.col("_zone") % 2 == 1
    key = [ordered_key(c) for c in (F.col("_v"), low, high)]
    cell = F.when(inside, _cells_of(*key, cells)).otherwise(0)
    counted = placed.groupBy(*keys, "_zone", cell.alias("_cell")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    # At most cells * probabilities + probabilities + 1 rows per group reach this window.
    ranked = _running(counted, keys, ["_zone", "_cell"])
    every = Window.partitionBy(*keys).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    ranked = ranked.withColumn("_total", F.sum("_n").over(every))
    wanted = [
        F.struct(F.lit(float(p)).alias("_p"), _rank(p, F.col("_total")).alias("_rank"))
        for p in probs
    ]
    ranked = ranked.withColumn("_w", F.explode(F.array(*wanted)))
    return _reached(ranked, F.col("_w._rank")).select(
        *keys,
        F.col("_w._p").alias("_p"),
        (F.col("_w._rank") - (F.col("_upto") - F.col("_n"))).alias("_need"),
        "_n",
        "_lo",
        "_hi",
    )


def _rows_within(rows: DataFrame, hits: DataFrame, size: int, keys: Sequence[str]) -> DataFrame:
    """The rows of the open cells, with the cell's columns; a row may be in several."""
    packed = hits.groupBy(*keys).agg(  # one entry per wanted percentile
        F.collect_list(F.struct("_p", "_need", "_lo", "_hi")).alias("_open")
    )
    near = attach_groups(rows, packed, keys, size=size)
    near = near.select(*keys, "_v", F.explode("_open").alias("_o")).select(*keys, "_v", "_o.*")
    return near.filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))


def _finer_cells(
    rows: DataFrame, hits: DataFrame, size: int, keys: Sequence[str], cells: int
) -> DataFrame:
    """The same ranks in cells of the cells they are in."""
    groups = [*keys, "_p", "_need"]
    cell = _cells_of(*[ordered_key(F.col(c)) for c in ("_v", "_lo", "_hi")], cells)
    counted = (
        _rows_within(rows, hits, size, keys)
        .groupBy(*groups, cell.alias("_cell"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    )
    return _reached(_running(counted, groups, ["_cell"]), F.col("_need")).select(
        *keys,
        "_p",
        (F.col("_need") - (F.col("_upto") - F.col("_n"))).alias("_need"),
        "_n",
        "_lo",
        "_hi",
    )


def _values_at(
    rows: DataFrame,
    brackets: DataFrame,
    probs: Sequence[float],
    keys: Sequence[str],
    cells: int,
    cell_rows: int,
) -> DataFrame:
    """keys..., _p, _v. ``brackets`` are computed already."""
    (size,) = _counted(brackets)
    hits = checkpointed(_first_cells(rows, brackets, size, probs, keys, cells))
    wide = F.max(F.when(F.col("_lo") < F.col("_hi"), F.col("_n")))
    size, most = _counted(hits, wide)
    while (most or 0) > cell_rows:
        hits = checkpointed(_finer_cells(rows, hits, size, keys, cells))
        size, most = _counted(hits, wide)
    single = hits.filter("_lo = _hi").select(*keys, "_p", F.col("_lo").alias("_v"))
    several = hits.filter("NOT _lo = _hi")
    near = _rows_within(rows, several, size, keys)
    values = near.groupBy(*keys, "_p", "_need", "_v").agg(F.count(F.lit(1)).alias("_n"))
    ranked = _running(values, [*keys, "_p", "_need"], ["_v"])
    return single.unionByName(_reached(ranked, F.col("_need")).select(*keys, "_p", "_v"))


def _counted(kept: DataFrame, *more: Column) -> tuple:
    """The bytes of a table that is computed already, and other figures of it, in one job."""
    size, *found = kept.agg(F.sum(row_bytes(kept)), *more).first()
    return size or 0, *found


def _cuts(probs: Sequence[float], accuracy: int) -> list[float]:
    margin = 2.0 / accuracy
    return [float(x) for p in probs for x in (max(0.0, p - margin), min(1.0, p + margin))]


def _bracket(value: Column, probs: Sequence[float], accuracy: int) -> Column:
    return F.array_sort(
        F.percentile_approx(value.cast("double"), _cuts(probs, accuracy), accuracy)
    )


def _named(found: DataFrame, columns: Mapping[str, Column], by: Sequence[str]) -> DataFrame:
    metric = F.get(F.array(*[F.lit(name) for name in columns]), F.col("_m"))
    return found.select(
        *by, metric.alias("metric"), F.col("_p").alias("p"), F.col("_v").alias("value")
    )


def exact_percentiles(
    df: DataFrame,
    columns: Mapping[str, Column],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = ACCURACY,
    cells: int = CELLS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Long form: by..., metric, p, value."""
    by, probs = list(by), sorted(probabilities)
    keys = [*by, "_m"]
    rows = _long_form(df, columns, by)
    brackets = rows.groupBy(*keys).agg(_bracket(F.col("_v"), probs, accuracy).alias("_cuts"))
    found = _values_at(rows, checkpointed(brackets), probs, keys, cells, cell_rows)
    return _named(found, columns, by)


def wide(long: DataFrame, names: Mapping[tuple[str, float], str], by: Sequence[str]) -> DataFrame:
    """One row per group, one column per (metric, probability)."""
    return long.groupBy(*by).agg(
        *[
            F.max(F.when((F.col("metric") == m) & (F.col("p") == float(p)), F.col("value"))).alias(n)
            for (m, p), n in names.items()
        ]
    )


def grouped_with_percentiles(
    df: DataFrame,
    by: Sequence[str],
    aggs: Sequence[Column],
    columns: Mapping[str, Column],
    names: Mapping[tuple[str, float], str],
    accuracy: int = ACCURACY,
    cells: int = CELLS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``df.groupBy(by).agg(aggs)`` with exact percentile columns.

    ``columns`` are the measured values, ``names`` maps (column, probability) to output names.
    """
    by, probs = list(by), sorted({p for _, p in names})
    marks = [_bracket(c, probs, accuracy).alias(f"__cuts_{i}") for i, c in enumerate(columns.values())]
    stats = checkpointed(df.groupBy(*by).agg(*aggs, *marks))
    cuts = F.array(*[F.col(f"__cuts_{i}") for i in range(len(columns))])
    brackets = stats.select(*by, F.posexplode(cuts).alias("_m", "_cuts")).filter("_cuts IS NOT NULL")
    rows = _long_form(df, columns, by)
    found = _values_at(rows, brackets, probs, [*by, "_m"], cells, cell_rows)
    pct = wide(_named(found, columns, by), names, by)
    plain = stats.drop(*[f"__cuts_{i}" for i in range(len(columns))])
    if not by:
        # Both are global aggregates: one row each.
        one = pct.select(F.lit(0).alias("_one"), *names.values())
        return plain.withColumn("_one", F.lit(0)).join(F.broadcast(one), "_one").drop("_one")
    renamed = pct.select(*[F.col(k).alias(f"__p_{k}") for k in by], *names.values())
    joined = plain.join(renamed, null_safe(plain, renamed, [(k, f"__p_{k}") for k in by]), "left")
    return joined.drop(*[f"__p_{k}" for k in by])
