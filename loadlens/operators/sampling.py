"""Samples and load sizes. A limit here is the feature asked for, always in a stated order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions.paths import run_label
from loadlens.operators.selection import rows_up_to
from loadlens.operators.sequence import dense_sequence


def _numbered_first(df: DataFrame, n: int, order: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows of every group, with their number ``_rn``.

    The n-th keys are found by counting, so that about ``n`` rows of a group are left before anything
    is shuffled (``rows_up_to``); these are numbered over all tasks.
    """
    near = rows_up_to(df, n, order, by)
    return dense_sequence(near, order, by, name="_rn").filter(F.col("_rn") <= n)


def first_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in ``order``, which should end in a unique key."""
    return _numbered_first(df, n, order, []).drop("_rn")


def balanced_sample(df: DataFrame, per_class: int, label: str, order: Sequence[str]) -> DataFrame:
    """The first ``per_class`` rows of every class, of which one may hold most of the rows."""
    return _numbered_first(df, per_class, order, [label]).drop("_rn")


def two_class_sample(
    df: DataFrame, total: int, classes: tuple[str, str], label: str, order: Sequence[str]
) -> DataFrame:
    """Half of ``total`` from each of two classes."""
    wanted = df.filter(F.col(label).isin(*classes))
    return balanced_sample(wanted, total // 2, label, order)


def runnable_sizes(sizes: Sequence[int], rows: int, otherwise: int | None = None) -> list[int]:
    """The sizes that ``rows`` rows can fill, from small to large.

    Where none can be filled, one run of ``otherwise`` rows, or of all rows if there are fewer. A
    test of another size than asked for is only what the caller names: without ``otherwise`` it
    is an error.
    """
    possible = sorted({n for n in sizes if 0 < n <= rows})
    if not possible and otherwise is not None and rows:
        possible = [min(otherwise, rows)]
    if not possible:
        raise ValueError(f"none of the sizes {list(sizes)} can be filled with {rows} rows")
    return possible


def runs_of(
    df: DataFrame, sizes: Sequence[int], order: Sequence[str], otherwise: int | None = None
) -> tuple[list[int], DataFrame]:
    """The run sizes, and the rows that any run needs with their number ``_rn``.

    One numbering serves all runs; run ``i`` is the rows numbered up to ``sizes[i]``.
    """
    chosen = runnable_sizes(sizes, df.count(), otherwise)
    return chosen, _numbered_first(df, chosen[-1], order, [])


def size_ladder(
    df: DataFrame,
    sizes: Sequence[int],
    order: Sequence[str],
    unit: str = "reqs",
    otherwise: int | None = None,
) -> DataFrame:
    """All runs of a load test in one table: row copies with ``run_label`` and ``run_size``.

    Run ``i`` holds the first ``sizes[i]`` rows in ``order``.
    """
    chosen, numbered = runs_of(df, sizes, order, otherwise)
    runs = [F.struct(F.lit(i).alias("index"), F.lit(n).alias("size")) for i, n in enumerate(chosen, 1)]
    return (
        numbered.withColumn("_run", F.explode(F.array(*runs)))
        .filter(F.col("_rn") <= F.col("_run.size"))
        .select(
            *df.columns,
            run_label("_run.index", "_run.size", unit).alias("run_label"),
            F.col("_run.size").alias("run_size"),
        )
    )
