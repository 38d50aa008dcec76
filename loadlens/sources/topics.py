"""Request topics, read as a bounded batch or as a stream.

Needs Spark's Kafka connector on the class path. Decoding is a separate step that takes any
table with a ``value`` column, so it can be fed from files as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _options(reader, servers: str, topic: str, extra: dict[str, str]):
    reader = reader.format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribe", topic)
    return reader.options(**extra)


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    ending: str = "latest",
    **extra: str,
) -> DataFrame:
    """All messages between two offsets. ``minPartitions`` among the extras splits hot partitions."""
    reader = _options(spark.read, servers, topic, extra)
    return reader.option("startingOffsets", starting).option("endingOffsets", ending).load()


def stream_topic(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **extra: str
) -> DataFrame:
    reader = _options(spark.readStream, servers, topic, extra)
    return reader.option("startingOffsets", starting).load()
