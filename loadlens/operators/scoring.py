"""Batched scoring with per-row timing and error capture.

The model is the caller's: ``init`` makes it once per task, ``score`` turns a pandas frame of a
few rows into one text per row. Columns that are only carried along stay Arrow arrays and keep
their type exactly. Python adds texts and whole microseconds; times and waits are derived from
them by Spark, so no pandas time zone rule is involved.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Init = Callable[[], Any]
Score = Callable[[Any, pd.DataFrame], Sequence[str]]


@dataclass(frozen=True)
class Scorer:
    score: Score
    init: Init | None = None
    micro_batch: int = 1
    device: str | Callable[[], str] = "CPU"
    clock: Callable[[], float] = time.time
    #: Whether a failed micro-batch is halved until the rows that fail are alone; else all its rows fail.
    halve: bool = False

    def device_name(self) -> str:
        return self.device() if callable(self.device) else self.device


LOAD_FAILED = "Model load failed: "
_RAW = T.StructType(
    [
        T.StructField("report_text", T.StringType()),
        T.StructField("inference_time_ms", T.DoubleType()),
        T.StructField("batch_size", T.IntegerType()),
        T.StructField("_dequeue_us", T.LongType()),
        T.StructField("_done_us", T.LongType()),
        T.StructField("gpu_used", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)


def _describe(problem: Exception) -> str:
    return f"{type(problem).__name__}: {problem}"


def _texts(scorer: Scorer, model: Any, part: pd.DataFrame) -> list[str]:
    made = list(scorer.score(model, part))
    if len(made) != len(part):
        raise ValueError(f"{len(made)} results for {len(part)} rows")
    if any(t is None for t in made):
        raise ValueError("no result")
    return [str(t) for t in made]


def _halved(scorer: Scorer, model: Any, part: pd.DataFrame) -> tuple[list[str], list[str | None]]:
    """Texts and errors of rows that failed together: only those that fail alone keep the error.

    The halves are scored again, and halved where they fail, so a culprit among b rows costs at most
    2 * log2(b) further calls. Rows that only fail in company are scored without it.
    """
    texts: list[str] = []
    errors: list[str | None] = []
    middle = len(part) // 2
    for half in (part.iloc[:middle], part.iloc[middle:]):
        found, problems = _scored_part(scorer, model, half)
        texts += found
        errors += problems
    return texts, errors


def _scored_part(scorer: Scorer, model: Any, part: pd.DataFrame) -> tuple[list[str], list[str | None]]:
    try:
        return _texts(scorer, model, part), [None] * len(part)
    except Exception as e:  # a failed micro-batch must not fail the job
        if scorer.halve and len(part) > 1:
            return _halved(scorer, model, part)
        return [""] * len(part), [_describe(e)] * len(part)


def _timed_groups(scorer: Scorer, model: Any, batch: pd.DataFrame):
    """Texts, milliseconds and errors of one Arrow batch, one micro-batch after the other.

    All rows of a micro-batch share its time evenly, and its error if it fails and is not halved.
    """
    texts: list[str] = []
    millis: list[float] = []
    errors: list[str | None] = []
    for start in range(0, len(batch), scorer.micro_batch):
        part = batch.iloc[start : start + scorer.micro_batch]
        began = scorer.clock()
        made, problems = _scored_part(scorer, model, part)
        each = (scorer.clock() - began) * 1000.0 / len(part)
        texts += made
        millis += [each] * len(part)
        errors += problems
    return texts, millis, errors


def _run(
    scorer: Scorer,
    read: Sequence[str],
    carried: Sequence[str],
    batches: Iterator[pa.RecordBatch],
):
    device = scorer.device_name()
    model, broken = None, None
    try:
        model = scorer.init() if scorer.init else None
    except Exception as e:  # every row of this task then carries the reason
        broken = f"{LOAD_FAILED}{e}"
    for batch in batches:
        dequeued, n = scorer.clock(), batch.num_rows
        if broken is None:
            texts, millis, errors = _timed_groups(scorer, model, batch.select(read).to_pandas())
        else:
            texts, millis, errors = [""] * n, [0.0] * n, [broken] * n
        done = scorer.clock()
        added = [
            pa.array(texts, pa.string()),
            pa.array(millis, pa.float64()),
            pa.array([n] * n, pa.int32()),
            pa.array([int(dequeued * 1_000_000)] * n, pa.int64()),
            pa.array([int(done * 1_000_000)] * n, pa.int64()),
            pa.array([device] * n, pa.string()),
            pa.array(errors, pa.string()),
        ]
        kept = [batch.column(c) for c in carried]
        yield pa.RecordBatch.from_arrays(kept + added, [*carried, *_RAW.names])


def score(
    requests: DataFrame,
    scorer: Scorer,
    inputs: Sequence[str] = (),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Score every request; rows out equal rows in, whether or not anything fails.

    ``inputs`` are further columns the scorer reads (``content``, say), ``carry`` further columns
    of the output. Nothing else reaches Python. Missing ids, times and labels are allowed.
    Filter and de-duplicate before this step: Spark cannot move a filter below it.
    """
    standard = ["request_id", "file_path", "ingest_ts", "true_label"]
    absent = [c for c in ("file_path", *inputs, *carry) if c not in requests.columns]
    if absent:
        raise ValueError(f"requests lack {absent}")
    fields = {f.name: f for f in requests.schema.fields}
    rows = requests.select(
        *[
            (F.col(c) if c in fields else F.lit(None).cast("string")).alias(c)
            for c in ("request_id", "file_path", "true_label")
        ],
        (
            F.unix_micros(F.col("ingest_ts").cast("timestamp"))
            if "ingest_ts" in fields
            else F.lit(None).cast("bigint")
        ).alias("_ingest_us"),
        *[c for c in dict.fromkeys([*inputs, *carry]) if c not in standard],
    )
    extra = [c for c in carry if c not in standard]
    carried = ["request_id", "file_path", "true_label", "_ingest_us", *extra]
    schema = T.StructType([*[rows.schema[c] for c in carried], *_RAW.fields])
    seen = dict.fromkeys(["request_id", "file_path", "true_label", *inputs])
    read = [c for c in seen if c != "ingest_ts"]

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _run(scorer, read, carried, batches)

    raw = rows.mapInArrow(partition, schema)
    ingest = F.col("_ingest_us")
    loaded = ~F.coalesce(F.col("error_message").startswith(LOAD_FAILED), F.lit(False))
    wait = F.when(loaded, (F.col("_dequeue_us") - ingest) / 1000.0).otherwise(F.lit(0.0))
    return raw.select(
        "request_id",
        "file_path",
        F.timestamp_micros(ingest).alias("ingest_ts"),
        F.timestamp_micros("_dequeue_us").alias("dequeue_ts"),
        wait.alias("queue_wait_ms"),
        "true_label",
        "report_text",
        "inference_time_ms",
        F.when(loaded, wait + F.col("inference_time_ms")).otherwise(0.0).alias("end_to_end_ms"),
        "batch_size",
        F.timestamp_micros("_done_us").alias("timestamp"),
        "gpu_used",
        "error_message",
        *extra,
    )
