"""Several tables published as a whole: a version in a folder of its own, and one pointer to it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT"


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _files(spark: SparkSession, root: str):
    return _path(spark, root).getFileSystem(spark._jsc.hadoopConfiguration())


def new_version(root: str) -> str:
    """A folder for the next version; nobody reads it before ``point_to``."""
    return f"{root.rstrip('/')}/versions/{uuid.uuid4().hex}"


def point_to(spark: SparkSession, root: str, version: str) -> None:
    """Make ``version`` the one that readers get. The pointer is written beside and moved last.

    Moving replaces the old pointer in one step where the store can (HDFS and local disks); readers
    find the old version before it and the new one after it, never a part of either.
    """
    jvm, root = spark._jvm, root.rstrip("/")
    name = version.rstrip("/").rsplit("/", 1)[-1]
    files = _files(spark, root)
    beside = _path(spark, f"{root}/.{POINTER}-{uuid.uuid4().hex}")
    out = files.create(beside, True)
    out.write(bytearray(name.encode()))
    out.close()
    whole = files.makeQualified(beside)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), spark._jsc.hadoopConfiguration())
    option = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    context.rename(whole, files.makeQualified(_path(spark, f"{root}/{POINTER}")), options)


def current(spark: SparkSession, root: str) -> str | None:
    """The folder of the published version, if there is one."""
    root = root.rstrip("/")
    if not _files(spark, root).exists(_path(spark, f"{root}/{POINTER}")):
        return None
    return f"{root}/versions/{spark.read.text(f'{root}/{POINTER}').first()[0]}"


def publish(
    spark: SparkSession, root: str, write: Callable[[str], object], keep: int = 2
) -> str:
    """Let ``write`` fill the folder of a new version, publish it and remove old ones.

    If ``write`` fails or the driver is lost, the earlier version stays readable and whole; what was
    written is removed with the next version that is published. ``keep`` versions stay, the newest
    and those before it, for readers that still use them.
    """
    before = current(spark, root)
    version = new_version(root)
    write(version)
    point_to(spark, root, version)
    files = _files(spark, root)
    kept = {version.rsplit("/", 1)[-1], before and before.rsplit("/", 1)[-1]}
    found = [s for s in files.listStatus(_path(spark, f"{root.rstrip('/')}/versions"))]
    others = [s for s in found if s.getPath().getName() not in kept]
    others.sort(key=lambda s: s.getModificationTime(), reverse=True)
    for status in others[max(0, keep - len(kept - {None})) :]:
        files.delete(status.getPath(), True)
    return version


def publish_tables(root: str, tables: Mapping[str, DataFrame], keep: int = 2) -> str:
    """Publish tables as Parquet, all of them or none."""
    spark = next(iter(tables.values())).sparkSession

    def write(version: str) -> None:
        for name, table in tables.items():
            table.write.parquet(f"{version}/{name}")

    return publish(spark, root, write, keep)


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the published version. A reader that takes several should ask ``current`` once."""
    version = current(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    return spark.read.parquet(f"{version}/{name}")
