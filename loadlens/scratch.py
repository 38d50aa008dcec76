"""Shared scratch space: where intermediate tables are written to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Where none is named, a master in this process gets a temporary one. On a cluster that is an
    error: a folder of the driver's machine would be useless to the others.
    """
    made = spark.sparkContext.getCheckpointDir()
    named = spark.conf.get(_CONF, None) or made
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set {_CONF} to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="loadlens-")
    if not made:
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new folder name under the scratch root; no two calls give the same one.

    All of a session's lie in one folder, which goes when the session's driver ends. ``discard``
    removes one earlier.
    """
    folder = f"{scratch_root(spark).rstrip('/')}/loadlens-{spark.sparkContext.applicationId}"
    if folder not in _FOLDERS:
        remove_on_exit(spark, folder)
        _FOLDERS.add(folder)
    return f"{folder}/{tag}-{uuid.uuid4().hex}"


_FOLDERS: set[str] = set()


def _located(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def remove_on_exit(spark: SparkSession, folder: str) -> None:
    """Make ``folder`` and have the driver remove it, with all that is in it, when it ends."""
    files, path = _located(spark, folder)
    files.mkdirs(path)
    files.deleteOnExit(path)


def discard(spark: SparkSession, folder: str) -> None:
    """Remove a folder whose tables nobody reads any more."""
    files, path = _located(spark, folder)
    files.delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the scratch folder, whatever becomes of the executors.

    Spark drops the files once nothing refers to the table any more, if the session has
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` set; nobody has to release them.
    """
    scratch_root(df.sparkSession)
    return df.checkpoint()
