"""Least-squares trends from distributive sums; nothing is fitted outside Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def linear_trend(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept")
    )


def _centre(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rows as doubles with x scaled to its own range, which keeps the sums well conditioned."""
    rows = df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    rows = rows.filter(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    ends = rows.agg(
        ((F.max("_x") + F.min("_x")) / 2).alias("_mid"),
        ((F.max("_x") - F.min("_x")) / 2).alias("_half"),
    ).withColumn("_one", F.lit(0))
    rows = rows.withColumn("_one", F.lit(0)).join(F.broadcast(ends), "_one")  # one row
    return rows.withColumn("_u", F.try_divide(F.col("_x") - F.col("_mid"), F.col("_half")))


def quadratic_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: coefficients of ``a*u^2 + b*u + c`` with ``u = (x - mid) / half`` in [-1, 1].

    The normal equations are solved in closed form on the one row of sums. NULL coefficients
    where fewer than three distinct x were seen.
    """
    u, v = F.col("_u"), F.col("_y")
    sums = _centre(df, x, y).agg(
        F.first("_mid").alias("mid"),
        F.first("_half").alias("half"),
        F.count(F.lit(1)).cast("double").alias("s0"),
        *[F.sum(F.pow(u, F.lit(k))).alias(f"s{k}") for k in (1, 2, 3, 4)],
        *[F.sum(F.pow(u, F.lit(k)) * v).alias(f"t{k}") for k in (0, 1, 2)],
    )

    def det(rows: list[list[str]]):
        (a, b, c), (d, e, f), (g, h, i) = [[F.col(n) for n in row] for row in rows]
        return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)

    base = [["s4", "s3", "s2"], ["s3", "s2", "s1"], ["s2", "s1", "s0"]]
    right = ["t2", "t1", "t0"]

    def replaced(column: int) -> list[list[str]]:
        return [
            [right[r] if c == column else base[r][c] for c in range(3)] for r in range(3)
        ]

    whole = det(base)
    solved = [F.try_divide(det(replaced(c)), whole).alias(n) for c, n in enumerate("abc")]
    return sums.select("mid", "half", *solved)


def quadratic_points(fit: DataFrame, points: int = 100) -> DataFrame:
    """The fitted curve on evenly spaced x from the smallest to the largest."""
    grid = fit.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    u = F.lit(-1.0) + F.col("point") * F.lit(2.0 / (points - 1))
    return grid.select(
        "point",
        (F.col("mid") + u * F.col("half")).alias("x"),
        (F.col("a") * u * u + F.col("b") * u + F.col("c")).alias("y"),
    )
