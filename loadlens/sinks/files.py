"""Prediction and metric tables as files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from loadlens.scratch import checkpointed

# Text with quotes, line breaks and outer blanks must come back as it was.
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    max_rows_per_file: int = 0,
    keep_others: bool = True,
) -> None:
    """Overwrite ``path``; with partition columns and ``keep_others`` only the partitions of ``df``.

    Each task writes its own file per partition value, so no value is gathered in one task.
    """
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", max_rows_per_file)
    if partition_by:
        mode = "dynamic" if keep_others else "static"
        writer = writer.option("partitionOverwriteMode", mode).partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header per file. ``single_file`` is for metric tables of a few rows."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").options(**_CSV).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; NULL fields stay visible."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_predictions(
    pred: DataFrame,
    root: str,
    formats: Sequence[str] = ("parquet", "csv", "json"),
    partition_by: Sequence[str] = (),
) -> dict[str, str]:
    """The prediction table once per format; Parquet first, the others from that copy.

    Scoring is the costly step, so it runs once: other formats read what was written.
    """
    paths = {f: f"{root.rstrip('/')}/predictions_{f}" for f in ("parquet", *formats)}
    write_parquet(pred, paths["parquet"], partition_by)
    stored = pred.sparkSession.read.schema(pred.schema).parquet(paths["parquet"])
    write_copies(stored, root, formats)
    return paths


def write_copies(stored: DataFrame, root: str, formats: Sequence[str]) -> None:
    """The other formats of a prediction table that is stored as Parquet already."""
    for name in formats:
        path = f"{root.rstrip('/')}/predictions_{name}"
        if name == "csv":
            write_csv(stored, path)
        elif name == "json":
            write_json(stored, path)
        elif name != "parquet":
            raise ValueError(f"unknown format {name}")


def write_metrics(tables: Mapping[str, DataFrame], targets: Sequence[str]) -> None:
    """Each metric table as one CSV file under every target folder, computed once."""
    for name, table in tables.items():
        kept = checkpointed(table)
        for target in targets:
            write_csv(kept, f"{target.rstrip('/')}/{name}", single_file=True)


def write_manifest(manifest: DataFrame, path: str) -> None:
    """One JSON object per line, which can be read in parallel."""
    write_json(manifest, path)


def register_view(pred: DataFrame, name: str = "predictions") -> DataFrame:
    """Make the table known to SQL under ``name``."""
    pred.createOrReplaceTempView(name)
    return pred
