"""Manifests, side tables and run summaries kept as JSON or CSV."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadlens import schemas

# Fixed value: what stands in for a missing 95th percentile.
P95_OVER_MEAN = 1.2
# Quoted multi-line text is only read whole with these.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def read_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, multi_line: bool = True
) -> DataFrame:
    """CSV with a header; all columns are text where no schema is given.

    ``multi_line=False`` lets Spark split large files, for tables without line breaks in cells.
    """
    reader = spark.read.options(**{**CSV_OPTIONS, "multiLine": str(multi_line).lower()})
    return (reader.schema(schema) if schema else reader).csv(path)


def read_optional_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """As :func:`read_csv`, but a missing path gives an empty table with the same columns."""
    try:
        return read_csv(spark, path, schema)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _starts_with_array(spark: SparkSession, path: str) -> bool:
    first = spark.read.text(path).filter("trim(value) <> ''").take(1)
    return bool(first) and first[0].value.lstrip("\ufeff \t").startswith("[")


def read_manifest(spark: SparkSession, path: str, layout: str = "auto") -> DataFrame:
    """Requests of a manifest: local_path and label of its entries.

    ``array`` is one JSON array per file, ``lines`` one JSON object per line, which Spark can split
    and which :func:`loadlens.sinks.files.write_manifest` writes. ``auto`` looks at the first
    character. Text that does not fit the layout is an error, never a missing row.
    """
    if layout not in ("auto", "array", "lines"):
        raise ValueError(f"unknown manifest layout {layout}")
    whole = layout == "array" or layout == "auto" and _starts_with_array(spark, path)
    reader = spark.read.schema(schemas.MANIFEST).option("mode", "FAILFAST")
    rows = reader.option("multiLine", whole).json(path)
    return rows.select(F.col("local_path").alias("file_path"), F.col("label").alias("true_label"))


def backfill_summary(summary: DataFrame) -> DataFrame:
    """Add the columns older run summaries lack.

    All images count as successes and none as errors; mean latency is the inverse of throughput
    and the 95th percentile a fixed multiple of the mean.
    """
    fills = {
        "success_count": F.col("num_images"),
        "error_count": F.lit(0).cast("long"),
        "mean_latency_ms": F.lit(1000.0) / F.col("wall_throughput_img_per_sec"),
        "p95_latency_ms": F.col("mean_latency_ms") * P95_OVER_MEAN,
    }
    for name, value in fills.items():
        if name not in summary.columns:
            summary = summary.withColumn(name, value)
    return summary


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """Run summary CSV with whatever columns its header names, typed and backfilled."""
    raw = read_csv(spark, path, multi_line=False)
    types = {f.name: f.dataType for f in schemas.RUN_SUMMARY.fields}
    typed = raw.select(*[F.col(c).cast(types[c]) if c in types else F.col(c) for c in raw.columns])
    return backfill_summary(typed)
