"""Joins of a large table with a side that is small in most runs, but not provably so."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.scratch import checkpointed

# Counted bytes up to which a side is sent to every executor.
MAX_BROADCAST_BYTES = 16 << 20


def row_bytes(df: DataFrame):
    """The size of a row as a column: its texts, binaries and arrays as they are, 16 bytes each else."""
    parts = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType | T.BinaryType):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)) + 16)
        elif isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 16)
        else:
            parts.append(F.lit(16))
    return reduce(lambda a, b: a + b, parts).cast("long")


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df``, summed over its rows, has at most ``max_bytes`` bytes. Reads it once."""
    return (df.agg(F.sum(row_bytes(df))).first()[0] or 0) <= max_bytes


def null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]):
    """Equality of all column pairs with NULL equal to NULL, as GROUP BY treats it."""
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def attach_groups(
    rows: DataFrame,
    groups: DataFrame,
    by: Sequence[str],
    *,
    known_small: bool = False,
    kept: bool = False,
    size: int | None = None,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Add per-group columns to every row (inner join on ``by``, NULL keys included).

    The groups are computed once. If their counted bytes allow they are broadcast, so the rows do
    not move and a hot group stays spread out. Beyond the bound it is a shuffle join, whose hot
    partitions adaptive execution splits. ``known_small`` skips all that where the size follows
    from the plan, e.g. one row of a global aggregate per requested column. ``kept`` says that the
    groups are already computed, ``size`` how many bytes their rows have, if that was counted.
    """
    renamed = groups.select(
        *[F.col(k).alias(f"__g_{k}") for k in by],
        *[c for c in groups.columns if c not in by],
    )
    if known_small:
        renamed = F.broadcast(renamed)
    else:
        if not kept and size is None:
            renamed = checkpointed(renamed)
        if size <= max_bytes if size is not None else fits_broadcast(renamed, max_bytes):
            renamed = F.broadcast(renamed)
    joined = rows.join(renamed, null_safe(rows, renamed, [(k, f"__g_{k}") for k in by]))
    return joined.drop(*[f"__g_{k}" for k in by])
