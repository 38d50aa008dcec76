"""Requests in flight: a stream of sent and answered requests, with time-outs from event time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from loadlens.streaming.requests import is_prepared

SENT, ANSWERED = "sent", "answered"
_OUT = T.StructType(
    [
        T.StructField("device", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("tick_us", T.LongType()),
        T.StructField("in_flight", T.LongType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("sent_us", T.LongType()),
        T.StructField("end_us", T.LongType()),
        T.StructField("outcome", T.StringType()),
    ]
)

#: Rows of a chunk of the state, and of a table that goes out, at most.
CHUNK_ROWS, OUT_ROWS = 10_000, 100_000
_CHUNK = pa.schema([("request_id", pa.string()), ("sent", pa.int64()), ("done", pa.int64())])


class _Requests(StatefulProcessor):
    """The open requests of one part of a device.

    Rows of a micro-batch come in any order, so nothing is decided when they come: they are put away
    as they are. At every tick the watermark has passed, all rows up to it are there: what has ended by
    then leaves, and what was under way at the tick is counted.

    The state is a list of chunks, each a table of many rows, as every access to a state is a message to
    the JVM: a request with a state of its own would need several.
    """

    def __init__(self, timeout_us: int, every_us: int):
        self.timeout, self.every = timeout_us, every_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("chunks", "number long", "rows binary")
        self.next_chunk = handle.getValueState("next_chunk", "number long")
        self.counted = handle.getValueState("counted", "tick_us long")  # the last tick that was

    def _next_tick(self, at_us):
        return -(-at_us // self.every) * self.every

    def _put(self, rows: pa.Table) -> None:
        held = self.next_chunk.get()
        number = held[0] if held else 0
        for start in range(0, rows.num_rows, CHUNK_ROWS):
            self.chunks.updateValue((number,), (_packed(rows.slice(start, CHUNK_ROWS)),))
            number += 1
        self.next_chunk.update((number,))

    def _take(self) -> pa.Table:
        """All rows put away, one a request: the earliest time it was sent and answered."""
        rows = pa.concat_tables([_CHUNK.empty_table(), *(_unpacked(v[0]) for v in self.chunks.values())])
        merged = rows.group_by("request_id").aggregate([("sent", "min"), ("done", "min")])
        self.chunks.clear()
        self.next_chunk.clear()
        return merged.select(["request_id", "sent_min", "done_min"]).rename_columns(_CHUNK.names)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, parts, held = None, [], 0
        for batch in rows:
            at, sent = batch.at_us.to_numpy("int64"), batch.is_sent.to_numpy(bool)
            names = pa.array(batch.request_id, pa.string(), from_pandas=True)
            parts.append(pa.table([names, pa.array(at, mask=~sent), pa.array(at, mask=sent)], schema=_CHUNK))
            first = int(at.min()) if first is None else min(first, int(at.min()))
            held += len(at)
            if held >= CHUNK_ROWS:
                self._put(pa.concat_tables(parts).combine_chunks())
                parts, held = [], 0
        if parts:
            self._put(pa.concat_tables(parts).combine_chunks())
        if first is not None:
            self.handle.registerTimer(self._next_tick(first) // 1000)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        reached = timerValues.getCurrentWatermarkInMs() * 1000
        last = reached // self.every * self.every
        before = self.counted.get()
        # Several timers may be due at once; the first counts all ticks reached, each once.
        if before is not None and last <= before[0]:
            return
        tick = expiredTimerInfo.getExpiryTimeInMs() * 1000
        tick = tick if before is None else max(tick, before[0] + self.every)
        self.counted.update((last,))
        rows = self._take()
        was_sent, was_done = (rows[c].is_valid().to_numpy() for c in ("sent", "done"))
        sent, done = (rows[c].fill_null(0).to_numpy() for c in ("sent", "done"))
        answered = was_sent & was_done & (done <= sent + self.timeout)
        end = np.where(was_sent & ~answered, sent + self.timeout, done)
        gone = self._next_tick(end) <= reached
        if not gone.all():
            self._put(rows.filter(pa.array(~gone)))
            self.handle.registerTimer((last + self.every) // 1000)
        ended = gone & was_sent  # else an answer to nothing
        names = rows["request_id"].filter(pa.array(ended))
        outcome = np.where(answered, "answered", "timeout")
        for start in range(0, len(names), OUT_ROWS):
            at = np.flatnonzero(ended)[start : start + OUT_ROWS]
            yield _made(
                key,
                request_id=names.slice(start, OUT_ROWS).to_pandas(),
                sent_us=sent[at],
                end_us=end[at],
                outcome=outcome[at],
            )
        levels = self._levels(sent[was_sent], end[was_sent], tick, reached)
        if levels:
            yield _made(key, tick_us=[t for t, _ in levels], in_flight=[n for _, n in levels])

    def _levels(self, sent: np.ndarray, end: np.ndarray, tick: int, reached: int) -> list[tuple[int, int]]:
        """Ticks from ``tick`` to ``reached`` with the number of requests sent by then that end after it."""
        start = np.maximum(tick, self._next_tick(sent))
        stop = self._next_tick(np.minimum(end, reached + 1))  # the first tick without it
        start, stop = start[start < stop], stop[start < stop]
        # Levels change only where a request comes or goes.
        edges, place = np.unique(np.concatenate([start, stop]), return_inverse=True)
        come, go = place[: len(start)], place[len(start) :]
        level = np.cumsum(np.bincount(come, minlength=len(edges)) - np.bincount(go, minlength=len(edges)))
        spans = zip(edges[:-1].tolist(), edges[1:].tolist(), level.tolist(), strict=False)
        return [(t, n) for a, b, n in spans if n for t in range(a, b, self.every)]

    def close(self) -> None:
        pass


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _CHUNK, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(chunk: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(bytes(chunk))).read_all()


def _made(key: tuple, **columns) -> pd.DataFrame:
    """Output rows of a device's part; columns not given are null."""
    made = pd.DataFrame(columns).reindex(columns=_OUT.names)
    made["device"], made["bucket"] = key
    for name in ("tick_us", "in_flight", "sent_us", "end_us"):
        made[name] = made[name].astype("Int64")
    return made.astype({name: object for name in ("device", "request_id", "outcome")})


def request_events(
    requests: DataFrame, answers: DataFrame, sent: str = "ingest_ts", done: str = "timestamp"
) -> DataFrame:
    """Both tables or streams as one of ``device, request_id, kind, at``."""

    def events(rows: DataFrame, kind: str, at: str) -> DataFrame:
        device = F.col("gpu_used").alias("device")
        return rows.select(device, "request_id", F.lit(kind).alias("kind"), F.col(at).alias("at"))

    return events(requests, SENT, sent).unionByName(events(answers, ANSWERED, done))


def track_requests(
    events: DataFrame, timeout: int, every: int, delay: str = "10 minutes", buckets: int = 16
) -> DataFrame:
    """What has become of every request, and how many were under way at every tick.

    ``events`` is a stream of ``device, request_id, kind, at``: a request is sent once and may be
    answered, in any order of arrival within ``delay``. It ends with its answer, or ``timeout``
    seconds after it was sent; a later answer changes nothing. Ticks are the multiples of ``every``
    seconds. The result depends on event times alone, not on micro-batches. Requests under way when
    the stream stops stay in the state and go on with the next start.

    The state of a device is in ``buckets`` parts by request, so a device with most of the requests
    is spread over tasks; state leaves with the request, at the first tick after its end.
    """
    if not is_prepared(events.sparkSession):
        raise RuntimeError("call prepare_session first: this state needs the store on disk")
    bucket = F.pmod(F.xxhash64("request_id"), F.lit(buckets)).cast("int")
    rows = events.withWatermark("at", delay).select(
        F.coalesce("device", F.lit("")).alias("device"),
        bucket.alias("bucket"),
        "request_id",
        F.col("kind").eqNullSafe(SENT).alias("is_sent"),
        F.unix_micros("at").alias("at_us"),
        "at",
    )
    return rows.groupBy("device", "bucket").transformWithStateInPandas(
        _Requests(timeout * 1_000_000, every * 1_000_000), _OUT, "Append", "EventTime"
    )


def ended(tracked: DataFrame) -> DataFrame:
    """``device, request_id, sent_us, end_us, outcome`` (answered or timeout)."""
    return tracked.filter("request_id IS NOT NULL").select(
        "device", "request_id", "sent_us", "end_us", "outcome"
    )


def levels(tracked: DataFrame) -> DataFrame:
    """``device, tick_us, in_flight``: requests sent by the tick that end after it, where there are any."""
    rows = tracked.filter("tick_us IS NOT NULL").groupBy("device", "tick_us")
    return rows.agg(F.sum("in_flight").alias("in_flight"))
