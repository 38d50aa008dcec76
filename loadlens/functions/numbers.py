"""Guarded arithmetic, unit scaling and threshold classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b``, NULL where ``b`` is zero or NULL."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def rounded(x: Column, digits: int | None) -> Column:
    return x if digits is None else F.round(x, digits)


def tier(value: Column | str, at_least: Sequence[tuple[float, object]], otherwise: object) -> Column:
    """Value of the first ``(threshold, result)`` pair, highest first, that ``value`` reaches."""
    v, out = _c(value), None
    for threshold, result in sorted(at_least, key=lambda p: p[0], reverse=True):
        hit = v >= F.lit(threshold)
        out = F.when(hit, F.lit(result)) if out is None else out.when(hit, F.lit(result))
    return F.when(v.isNotNull(), out.otherwise(F.lit(otherwise)))


def latency_class(ms: Column | str) -> Column:
    """Fixed limits: below 5000 ms is fast, below 15000 ms is medium, the rest is slow."""
    return tier(ms, [(15000.0, "slow"), (5000.0, "medium")], "fast")


def micro_batch_for_memory(gb: Column | str) -> Column:
    """Fixed sizes: 8, 4, 2 from 80, 40, 24 GB of device memory on, else 1."""
    return tier(gb, [(80.0, 8), (40.0, 4), (24.0, 2)], 1)


def rate_of(sec: Column | str) -> Column:
    """Rows per second of one row that took ``sec``; 0 where it took no time."""
    s = _c(sec)
    return F.when(s > 0, F.lit(1.0) / s).otherwise(F.lit(0.0))


def status(error: Column | str = "error_message") -> Column:
    return F.when(_c(error).isNull(), F.lit("Success")).otherwise(F.lit("Error"))


def succeeded(error: Column | str = "error_message") -> Column:
    return _c(error).isNull()
