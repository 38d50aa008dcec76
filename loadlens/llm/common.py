"""Small things the operators share: reading, null texts, cutting lineage."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.scratch import remove_on_exit


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, a null counting as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    A folder of our own is made only for a local master whose session names none, as in tests.
    """
    context = spark.sparkContext
    found = context.getCheckpointDir()
    if found:
        return found
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="loadlens-llm-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def own_folder(spark: SparkSession, tag: str) -> str:
    """A new folder in the shared one; what is left in it goes when the driver ends."""
    root = f"{scratch_dir(spark).rstrip('/')}/own"
    if root not in _MADE:
        remove_on_exit(spark, root)
        _MADE.add(root)
    return f"{root}/{tag}-{uuid.uuid4().hex}"


_MADE: set[str] = set()


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared folder, so that a lost executor costs nothing."""
    scratch_dir(df.sparkSession)
    return df.checkpoint()


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def release() -> None:
    """Give back what a task held: its Python worker lives on, and other stages need the memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)
