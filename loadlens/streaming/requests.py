"""Request streams: file sources, decoding and de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from loadlens.operators.decode import decode_requests

# What every stream of this package runs with: state of keyed operators on disk, and bursts of one
# key merged within a task before the shuffle.
STREAM_OPTIONS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def prepare_session(spark: SparkSession) -> None:
    """Set ``STREAM_OPTIONS`` for the queries the session starts from now on."""
    for name, value in STREAM_OPTIONS.items():
        spark.conf.set(name, value)


def is_prepared(spark: SparkSession) -> bool:
    return all(spark.conf.get(k, None) == v for k, v in STREAM_OPTIONS.items())


def stream_parquet(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    glob: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Files of a folder as a stream; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def stream_requests(messages: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Message stream to requests with a watermark on their ingest time."""
    return decode_requests(messages).withWatermark("ingest_ts", delay)


def distinct_stream(
    requests: DataFrame, key: str = "request_id", within: str | None = None
) -> DataFrame:
    """First arrival per id; ids are remembered only as long as the watermark needs.

    If one id may fill much of the stream, ``within`` names a column its copies differ in, the
    topic partition say. Copies then leave per value of it first, and few meet in one task.
    """
    if within:
        requests = requests.dropDuplicatesWithinWatermark([key, within])
    return requests.dropDuplicatesWithinWatermark([key])
