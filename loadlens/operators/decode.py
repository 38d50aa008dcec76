"""Message bodies to requests, and what to do with the ones that are not requests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens import schemas
from loadlens.functions.messages import body_struct
from loadlens.functions.times import parse_iso
from loadlens.joins import fits_broadcast
from loadlens.scratch import checkpointed

REQUIRED = ("file_path", "request_id", "ingest_ts")


def parse_bodies(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Flat request columns of every message; all NULL where the body is not JSON.

    A generator of one row: later filters stay above it, so a body is parsed once. As a plain
    column it would be parsed again for each field a filter looks at.
    """
    parsed = F.inline_outer(F.array(body_struct(value, schemas.REQUEST_MESSAGE)))
    names = schemas.REQUEST_MESSAGE.fieldNames()
    return raw.select(
        *keep, F.col(value).cast("string").alias("body"), parsed.alias(*names)
    )


def _typed(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("ingest_text", F.col("ingest_ts")).withColumn(
        "ingest_ts", parse_iso("ingest_ts")
    )


def _complete(required: tuple[str, ...] = REQUIRED):
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])


def decode_requests(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Requests with path, id and a readable time. Map-only; works on batch and stream."""
    return _typed(parse_bodies(raw, value, keep)).filter(_complete()).drop("body", "ingest_text")


def decode_paths(raw: DataFrame, value: str = "value") -> DataFrame:
    """Only path and label, for sources whose messages carry no id or time."""
    parsed = parse_bodies(raw, value).select("file_path", "true_label")
    return parsed.filter(F.col("file_path").isNotNull())


def rejected_requests(
    raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """The messages :func:`decode_requests` drops, with the reason."""
    reason = (
        F.when(
            F.col("file_path").isNull() & F.col("request_id").isNull() & F.col("ingest_text").isNull(),
            "unreadable",
        )
        .when(F.col("file_path").isNull(), "no file_path")
        .when(F.col("request_id").isNull(), "no request_id")
        .when(F.col("ingest_text").isNull(), "no ingest_ts")
        .otherwise("bad ingest_ts")
    )
    typed = _typed(parse_bodies(raw, value, keep)).filter(~_complete())
    return typed.select(*keep, "body", reason.alias("reason"))


def distinct_requests(requests: DataFrame, key: str = "request_id") -> DataFrame:
    """One request per id: the earliest, then the smallest path.

    Ids are counted by hash first, so only numbers and ids move. Rows whose id occurs once stay where
    they are read; only those of repeated ids are compared as whole rows, each task reducing its own
    first. The repeated ids are sent to all tasks if their counted bytes allow. Reads the input twice.
    """
    ids = requests.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    repeated = checkpointed(ids.select(F.col(key).alias("_repeated")))
    if fits_broadcast(repeated):
        repeated = F.broadcast(repeated)
    same = requests[key].eqNullSafe(F.col("_repeated"))
    rest = [c for c in requests.columns if c not in (key, "ingest_ts", "file_path")]
    first = F.min(F.struct("ingest_ts", "file_path", *rest)).alias("_first")
    picked = requests.join(repeated, same, "left_semi").groupBy(key).agg(first)
    picked = picked.select(*[key if c == key else F.col(f"_first.{c}") for c in requests.columns])
    return requests.join(repeated, same, "left_anti").unionByName(picked)
