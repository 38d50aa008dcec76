"""Where streams end. Progress and output live in shared folders, so a restart goes on."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from loadlens.scratch import scratch_path
from loadlens.sinks.messages import as_messages


def to_parquet(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    every: str | None = None,
) -> StreamingQuery:
    """Append to a Parquet table exactly once. Without ``every`` it stops at the end of the input
    known at the start, which is the bounded read of a topic, but resumable."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path)


def to_topic(
    stream: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None
) -> StreamingQuery:
    """Rows as JSON messages of an output topic; needs Spark's Kafka connector."""
    writer = as_messages(stream, key).writeStream.format("kafka").outputMode("append")
    writer = writer.option("kafka.bootstrap.servers", servers).option("topic", topic)
    return writer.option("checkpointLocation", checkpoint).start()


def metrics_per_batch(
    stream: DataFrame, metrics: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> StreamingQuery:
    """A metric table per micro-batch, in a folder named by the batch.

    A repeated batch overwrites its own folder, so a restart does not count anything twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        metrics(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def run_to_table(stream: DataFrame, tag: str) -> DataFrame:
    """Drain the stream's present input into a scratch Parquet table and read that."""
    spark = stream.sparkSession
    root = scratch_path(spark, f"stream-{tag}")
    to_parquet(stream, f"{root}/table", f"{root}/progress").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/table")
