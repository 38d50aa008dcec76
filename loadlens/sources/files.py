"""File trees and object stores through Spark's ``binaryFile`` source.

Suffixes are handed to the source as a glob, so other files never become part of a scan, and
``content`` is read only by the functions that return it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions import paths


def suffix_glob(suffixes: Sequence[str] | None, ignore_case: bool = True) -> str | None:
    """One glob for all suffixes: ``*.[pP][nN][gG]`` style where case is ignored."""
    if not suffixes:
        return None

    def loose(s: str) -> str:
        return "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in s)

    parts = [loose(s) if ignore_case else s for s in suffixes]
    return f"*{parts[0]}" if len(parts) == 1 else "*{" + ",".join(parts) + "}"


def _binary(spark: SparkSession, root: str, suffixes, ignore_case: bool) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    glob = suffix_glob(suffixes, ignore_case)
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(root)


def read_assets(
    spark: SparkSession,
    root: str,
    suffixes: Sequence[str] | None = paths.IMAGE_SUFFIXES,
    ignore_case: bool = True,
) -> DataFrame:
    """Files with their bytes: file_path, length, content."""
    return _binary(spark, root, suffixes, ignore_case).select(
        F.col("path").alias("file_path"), "length", "content"
    )


def list_assets(
    spark: SparkSession,
    root: str,
    suffixes: Sequence[str] | None = paths.IMAGE_SUFFIXES,
    ignore_case: bool = True,
) -> DataFrame:
    """Files without their bytes: image_id, file_path, file_size_bytes."""
    return _binary(spark, root, suffixes, ignore_case).select(
        paths.file_name("path").alias("image_id"),
        F.col("path").alias("file_path"),
        F.col("length").alias("file_size_bytes"),
    )


def list_unlabelled(
    spark: SparkSession,
    root: str,
    suffixes: Sequence[str] = (".png",),
    ignore_case: bool = False,
) -> DataFrame:
    """Requests for every file under ``root``, label unknown."""
    return _binary(spark, root, suffixes, ignore_case).select(
        F.col("path").alias("file_path"), F.lit(None).cast("string").alias("true_label")
    )


def list_labelled(
    spark: SparkSession,
    root: str,
    labels: Sequence[str] | None = None,
    suffixes: Sequence[str] = paths.IMAGE_SUFFIXES,
) -> DataFrame:
    """Requests for every file of a ``root/<label>/<file>`` tree, label taken from the folder."""
    out = _binary(spark, root, suffixes, True).select(
        F.col("path").alias("file_path"), paths.parent_name("path").alias("true_label")
    )
    return out.filter(F.col("true_label").isin(*labels)) if labels else out


def flatten_splits(files: DataFrame, path_col: str = "file_path") -> DataFrame:
    """Fold ``.../<split>/<label>/<file>`` paths into one row per (label, ``<split>_<file>``).

    Where several files fold into one name, the first path in order is kept.
    """
    split = paths.parent_name(path_col, 2)
    return (
        files.filter(split.isin(*paths.SPLITS))
        .groupBy(
            paths.parent_name(path_col).alias("true_label"),
            paths.flat_name(split, paths.file_name(path_col)).alias("flat_name"),
        )
        .agg(F.min(path_col).alias("file_path"))
    )
