"""Rows as topic messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions.messages import to_body


def as_messages(
    df: DataFrame, key: str | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """One JSON ``value`` per row, and a ``key`` column where one is named."""
    body = to_body(list(columns or df.columns)).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), body) if key else df.select(body)


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Batch write; needs Spark's Kafka connector."""
    writer = messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("topic", topic).save()
