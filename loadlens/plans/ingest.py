"""Request generation: file listings to numbered request messages, and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.functions import messages, paths, times
from loadlens.operators.sampling import balanced_sample, first_n
from loadlens.operators.sequence import dense_sequence


def number_requests(
    listing: DataFrame, limit: int | None = None, at: Column | None = None
) -> DataFrame:
    """Requests in (label, path) order with ids ``req_00000000`` on and one ingest time.

    ``listing`` has file_path and true_label. ``limit`` keeps the first few files only.
    """
    order = ["true_label", "file_path"]
    rows = first_n(listing, limit, order) if limit is not None else listing
    moment = F.current_timestamp() if at is None else at
    return dense_sequence(rows, order, start=0, name="_n").select(
        "file_path",
        "true_label",
        paths.request_id("_n").alias("request_id"),
        times.iso_text(moment).alias("ingest_ts"),
    )


def request_messages(requests: DataFrame) -> DataFrame:
    """Requests as topic rows with one JSON ``value`` each and no key."""
    return requests.select(
        messages.to_body(["file_path", "true_label", "request_id", "ingest_ts"]).alias("value")
    )


def preview(requests: DataFrame, n: int = 10) -> DataFrame:
    """The first few messages of a dry run."""
    return request_messages(first_n(requests, n, ["request_id"]))


def manifest(listing: DataFrame, bucket: str, per_class: int | None = None) -> DataFrame:
    """Object keys and URIs of listed files, or of a balanced sample of them."""
    rows = listing
    if per_class is not None:
        rows = balanced_sample(listing, per_class, "true_label", ["file_path"])
    key = paths.object_key("true_label", paths.file_name("file_path"))
    return rows.select(
        key.alias("s3_key"),
        paths.object_uri(bucket, key).alias("s3_uri"),
        F.col("file_path").alias("local_path"),
        F.col("true_label").alias("label"),
    )
