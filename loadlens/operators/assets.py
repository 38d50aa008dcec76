"""Requests matched to the files they name."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions.paths import normalize_path
from loadlens.joins import MAX_BROADCAST_BYTES, fits_broadcast


def _keyed(df: DataFrame, path: str = "file_path") -> DataFrame:
    return df.withColumn("_key", normalize_path(path))


def match_assets(requests: DataFrame, listing: DataFrame, salts: int = 1) -> DataFrame:
    """Requests whose file exists, with the listing's columns; no file bytes involved.

    Repeated requests for one file all stay. Spark picks the strategy: rows are narrow, and
    adaptive execution splits the partition of a much requested file. Streams lack that; for
    them ``salts`` spreads each file's requests over as many copies of its listing row. A file that
    is listed in two spellings counts once.
    """
    extra = [c for c in listing.columns if c not in ("file_path", "content")]
    clash = [c for c in extra if c in requests.columns]
    if clash:
        raise ValueError(f"both sides have {clash}")
    files = _keyed(listing).select("_key", F.col("file_path").alias("asset_path"), *extra)
    files = files.dropDuplicates(["_key"])
    wanted, keys = _keyed(requests), ["_key"]
    if salts > 1:
        keys = ["_key", "_salt"]
        spread = F.pmod(F.xxhash64(*requests.columns), F.lit(salts)).cast("int")
        wanted = wanted.withColumn("_salt", spread)
        files = files.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return wanted.join(files, keys).select(*requests.columns, "asset_path", *extra)


def missing_assets(requests: DataFrame, listing: DataFrame) -> DataFrame:
    """Requests that name no known file."""
    return _keyed(requests).join(_keyed(listing).select("_key"), "_key", "left_anti").drop("_key")


def join_assets(
    requests: DataFrame,
    assets: DataFrame,
    content: str = "content",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Requests with the bytes of their file (inner join, one row per request).

    The wide side is the files. Where the requests pass the size check they are broadcast, so
    bytes stay where they were read. Otherwise both sides shuffle; callers whose files are
    large should then use :func:`match_assets` and :func:`fetch_content`, which moves no bytes.
    """
    keyed = _keyed(requests)
    if fits_broadcast(requests, max_broadcast_bytes):
        keyed = F.broadcast(keyed)
    files = _keyed(assets).select("_key", content)
    return files.join(keyed, "_key").select(*requests.columns, content)


def _open(systems: dict, name: str):
    """A file's stream. The path is taken as it is: blanks, ``%`` and ``#`` are part of names."""
    from pyarrow import fs

    scheme, found, rest = name.partition("://")
    if not found or scheme == "file":
        place, inner = "file", "/" + (rest if found else name.removeprefix("file:")).lstrip("/")
    else:
        scheme = "s3" if scheme in ("s3a", "s3n") else scheme
        container, _, key = rest.partition("/")
        place = f"{scheme}://{container}"
        inner = f"{container}/{key}" if scheme in ("s3", "gs", "abfs", "abfss") else f"/{key}"
    if place not in systems:  # one connection per store and task
        local = place == "file"
        systems[place] = fs.LocalFileSystem() if local else fs.FileSystem.from_uri(place + "/")[0]
    return systems[place].open_input_stream(inner)


def fetch_content(
    requests: DataFrame, path: str = "asset_path", max_chunk_bytes: int = 64 << 20
) -> DataFrame:
    """Read each request's file inside the task that holds the request.

    Narrow rows are what Spark partitions; bytes are read once by the task that scores them and
    never shuffled. Output leaves in chunks of bounded size. ``fetch_error`` says why ``content``
    is NULL: there is no path, or no such file. Any other failure to read fails the task, so that
    Spark tries it again and nothing is lost without a word.
    """
    schema = T.StructType(
        [
            *requests.schema.fields,
            T.StructField("content", T.BinaryType()),
            T.StructField("fetch_error", T.StringType()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        systems: dict = {}

        def load(name: str | None) -> tuple[bytes | None, str | None]:
            if name is None:
                return None, "no path"
            try:
                with _open(systems, name) as stream:
                    return stream.read(), None
            except FileNotFoundError:
                return None, "not found"

        def with_bytes(batch: pa.RecordBatch, start: int, held: list) -> pa.RecordBatch:
            part = batch.slice(start, len(held))
            content, problems = zip(*held, strict=True)
            part = part.append_column("content", pa.array(content, pa.binary()))
            return part.append_column("fetch_error", pa.array(problems, pa.string()))

        for batch in batches:
            start, held, size = 0, [], 0
            for name in batch.column(path).to_pylist():
                held.append(load(name))
                size += len(held[-1][0] or b"")
                if size >= max_chunk_bytes:
                    yield with_bytes(batch, start, held)
                    start, held, size = start + len(held), [], 0
            if held:
                yield with_bytes(batch, start, held)

    return requests.mapInArrow(read, schema)
