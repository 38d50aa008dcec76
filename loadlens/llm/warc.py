"""WARC archives: written in segments with chunked payloads, read back and put together again."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.joins import fits_broadcast
from loadlens.llm.common import cut, own_folder, text_of

CRLF = b"\r\n"
#: Bytes of a record's block; longer responses are continued in further records.
SEGMENT = 1 << 12
#: Bytes of a chunk of the transfer coding.
CHUNK = 1 << 13
#: Records in one file, so that a file is at most about 16 MB.
FILE_RECORDS = 4096
#: Bytes of rows that the reader hands on at a time.
READ_BYTES = 4 << 20
_URN = "urn:loadlens:page:"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The payload in the chunked transfer coding."""
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        parts += [b"%x" % len(piece), CRLF, piece, CRLF]
    return b"".join([*parts, b"0", CRLF, CRLF])


def unchunked(coded: bytes) -> bytes | None:
    """The payload of a chunked body, extensions and trailers skipped; None if it is cut short."""
    parts, at = [], 0
    while True:
        end = coded.find(CRLF, at)
        if end < 0:
            return None
        try:
            size = int(coded[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if size < 0 or coded[at + size : at + size + 2] != CRLF:
            return None
        parts.append(coded[at : at + size])
        at += size + 2


def payload_of(block: bytes | None) -> bytes | None:
    """The payload of an HTTP response; None if the response is missing or broken."""
    if block is None:
        return None
    head, found, body = block.partition(CRLF + CRLF)
    if not found:
        return None
    fields = dict(
        (k.strip().lower(), v.strip().lower())
        for k, _, v in (line.partition(b":") for line in head.split(CRLF)[1:])
    )
    return unchunked(body) if fields.get(b"transfer-encoding") == b"chunked" else body


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without the two line ends after it; the writer puts them between records."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + CRLF + CRLF + block


def records(
    name: str, key: str, url: str, payload: bytes, digest: str, first: str | None, segment: int
) -> list[bytes]:
    """The records of one page: a revisit of ``first``, or a response in one or more segments."""
    url = "".join(url.split())
    common = [
        ("WARC-Target-URI", url),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    own = f"<{_URN}{name}:{key}>"
    if first is not None:
        fields = [
            ("WARC-Type", "revisit"),
            ("WARC-Record-ID", own),
            ("WARC-Refers-To", f"<{_URN}{first}>"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ]
        return [_record(fields + common, head + CRLF)]
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    pieces = [block[i : i + segment] for i in range(0, len(block), segment)]
    out = []
    for n, piece in enumerate(pieces, 1):
        kind = "response" if n == 1 else "continuation"
        rid = own if n == 1 else f"<{_URN}{name}:{key}:{n}>"
        fields = [("WARC-Type", kind), ("WARC-Record-ID", rid)]
        if len(pieces) > 1:
            fields.append(("WARC-Segment-Number", str(n)))
            if n > 1:
                fields.append(("WARC-Segment-Origin-ID", own))
            if n == len(pieces):
                fields.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(_record(fields + common, piece))
    return out


def inflated(archive: bytes) -> bytes:
    """All members of a gzip file; of one that is cut short or damaged, what comes before that."""
    parts = []
    while archive[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        try:
            parts.append(member.decompress(archive))
        except zlib.error:
            break
        archive = member.unused_data
    return b"".join(parts)


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record, by the stated lengths.

    A record without a length, or whose length is no number, is left out, and reading goes on with
    the next record that begins after an empty line. One that is cut short ends the archive.
    """
    if archive[:2] == b"\x1f\x8b":
        archive = inflated(archive)
    at = archive.find(b"WARC/")
    while at >= 0:
        end = archive.find(CRLF + CRLF, at)
        if end < 0:
            return
        lines = archive[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start, length = end + 4, _number(fields.get("content-length"))
        if length is None:
            at = archive.find(CRLF + CRLF + b"WARC/", end)
            at = at + 4 if at >= 0 else -1
            continue
        if start + length > len(archive):
            return
        yield fields, archive[start : start + length]
        at = archive.find(b"WARC/", start + length)


def _number(text: str | None) -> int | None:
    """A whole number of the range of a record's fields, or None."""
    return int(text) if text and text.isascii() and text.isdigit() and len(text) < 19 else None


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 (RFC 4648) of a hex string whose length is a multiple of five digits."""
    fives = [F.substring(hex_digest, i, 5) for i in range(1, 41, 5)]
    digits = F.concat(*[F.lpad(F.conv(f, 16, 32), 4, "0") for f in fives])
    return F.translate(
        digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


@F.arrow_udf(T.ArrayType(T.BinaryType()))
def _records(
    names: pa.Array,
    keys: pa.Array,
    urls: pa.Array,
    payloads: pa.Array,
    digests: pa.Array,
    firsts: pa.Array,
    segments: pa.Array,
) -> pa.Array:
    columns = [c.to_pylist() for c in (names, keys, urls, payloads, digests, firsts, segments)]
    return pa.array([records(*row) for row in zip(*columns, strict=True)], pa.list_(pa.binary()))


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
    segment: int = SEGMENT,
) -> None:
    """Write every row as a record into gzipped WARC files in ``folder``.

    Of rows with equal payloads of at least ``least_bytes`` bytes the one with the largest id is
    the response; the others are revisits of it, without payload. Rows are paired by a narrow table
    of ids and SHA-256 digests, combined before its shuffle; only ids and digests go through the
    join of a digest that many rows share, which adaptive execution splits. Payloads stay where they are
    read, or move by id if there are very many revisits. Ids may be any text. A null html is an empty payload, a null url an empty one. Rows of a null id are never
    referred to. Repeated rows have records of their own. Files are bounded in records and a
    record in bytes; the writer is Spark's, so a lost task's files are not seen.
    """
    base = pages.select(
        F.col(id_col).alias("page_id"),
        F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        F.encode(text_of(html_col), "UTF-8").alias("payload"),
    )
    strong = F.unhex(F.sha2("payload", 256)).alias("strong")
    prints = cut(base.select("page_id", strong, F.length("payload").alias("n")))
    last = prints.filter(F.col("n") >= least_bytes).groupBy("strong")
    last = last.agg(F.max("page_id").alias("first"), F.count("*").alias("rows")).filter("rows > 1")
    revisits = (
        prints.join(last, "strong").filter("page_id <> first").select("page_id", "strong", "first")
    ).dropDuplicates(["page_id", "strong"])
    revisits = cut(revisits)
    if fits_broadcast(revisits):  # by its counted bytes; then no payload moves
        revisits = F.broadcast(revisits)
    marked = base.withColumn("strong", strong).join(revisits, ["page_id", "strong"], "left")
    made = _records(
        F.coalesce(_spelled("page_id"), F.lit("")),
        F.uuid(),
        "url",
        F.when(F.col("first").isNull(), F.col("payload")).otherwise(F.lit(b"")),
        base32(F.sha1("payload")),
        _spelled("first"),
        F.lit(segment),
    )
    lines = marked.select(F.explode(made).alias("r")).select(F.col("r").cast("string"))
    writer = lines.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", FILE_RECORDS)
    writer.option("compression", "gzip").text(folder)


def _spelled(column: str) -> Column:
    """An id as it stands in a record id, after a sign that tells an empty one from none."""
    return F.concat(F.lit("="), F.url_encode(F.col(column).cast("string")))


_READ = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("segment", T.IntegerType()),
        T.StructField("total", T.LongType()),
        T.StructField("block", T.BinaryType()),
    ]
)


def _read(batches):
    names = ["warc-record-id", "warc-type", "warc-target-uri", "warc-payload-digest"]
    names += ["warc-refers-to", "warc-segment-origin-id"]
    for b in batches:
        for content in b.column(0):
            rows, size = [], 0
            for fields, block in parse(content.as_py()):
                number, total = (
                    fields.get(f"warc-segment-{k}") for k in ("number", "total-length")
                )
                row = [fields.get(n) for n in names]
                row += [_number(number), _number(total), block]
                if number is None:  # a record of its own is its only segment
                    row[6:8] = 1, len(block)
                row[5] = row[5] or row[0]
                rows.append(dict(zip(_READ.names, row, strict=True)))
                size += len(block) + 500
                if size >= READ_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _ARROW)


_ARROW = pa.schema(
    [(n, pa.string()) for n in _READ.names[:6]]
    + [("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary())]
)


def whole_block(segments: list[tuple[int | None, int | None, bytes]]) -> bytes | None:
    """The blocks of segments (number, total, block) in order; None unless 1 to n are there and their
    bytes add up to the total. A segment that is there twice with equal content counts once."""
    found = sorted(set(segments), key=lambda s: s[0] or 0)
    block = b"".join(s[2] for s in found)
    totals = {s[1] for s in found if s[1] is not None}
    numbered = [s[0] for s in found] == list(range(1, len(found) + 1))
    return block if numbered and totals == {len(block)} else None


_WHOLE = T.StructType([*_READ.fields[:5], T.StructField("payload", T.BinaryType())])


def _assembled(batches):
    """Segments in the order of their origins to responses and revisits; one origin is held at a time."""

    def rows():
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield from batch.slice(at, 256).to_pylist()

    out, size = [], 0
    for origin, own in groupby(rows(), lambda r: r["origin"]):
        own = list(own)
        first = next((r for r in own if r["segment"] == 1), None)
        if first is None or first["type"] not in ("response", "revisit"):
            continue
        row = {n: first[n] for n in _WHOLE.names[1:5]} | {"record_id": origin, "payload": None}
        if first["type"] == "response":
            block = whole_block([(r["segment"], r["total"], r["block"]) for r in own])
            row["payload"] = payload_of(block)
        out.append(row)
        size += len(row["payload"] or b"") + 500
        if size >= READ_BYTES:
            yield pa.RecordBatch.from_pylist(out, _WHOLE_ARROW)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, _WHOLE_ARROW)


_WHOLE_ARROW = pa.schema([(n, pa.string()) for n in _WHOLE.names[:5]] + [("payload", pa.binary())])


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``record_id, type, uri, digest, refers_to, payload`` of every response and revisit.

    Files are read whole by Spark, once, and parsed by the stated lengths, so a payload may hold
    anything. Segments are dealt to tasks by the id of their origin and sorted by it and their number; a
    record that is not segmented is its own only segment. The blocks of an origin, which are one
    payload, are joined if all are there once and their bytes add up to the stated total length; else
    the payload is null. Segments that appear twice with equal content count once. Chunked transfer
    coding is removed; a body that is cut short has a null payload, and so has a revisit. Other record
    types are left out, and broken records as ``parse`` says. An empty folder gives no rows.
    """
    files = spark.read.format("binaryFile").load(folder).select("content")
    rows = files.mapInArrow(_read, _READ).filter("origin IS NOT NULL")
    dealt = rows.repartition("origin").sortWithinPartitions("origin", "segment")
    return dealt.mapInArrow(_assembled, _WHOLE)


def page_of(urn: str | Column) -> Column:
    """The page id within a record id of ``write_archives``; null if the page had none."""
    found = F.regexp_extract(urn, f"^<{_URN}(=[^:>]*)", 1)
    return F.when(found != "", F.url_decode(F.substring(found, 2, 1 << 20)))


def round_trip(pages: DataFrame, id_col: str = "page_id", *, segment: int = SEGMENT) -> DataFrame:
    """Write ``pages``, read the archives, and describe each page by what was read.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``: length and digest are those
    of the payload read, for a revisit those of the response it refers to, whose digest must be the
    revisit's own; else they are null. One row per record.
    """
    spark = pages.sparkSession
    folder = own_folder(spark, "warc")
    write_archives(pages, folder, id_col=id_col, segment=segment)
    kind = pages.schema[id_col].dataType
    read = cut(
        read_archives(spark, folder).select(
            page_of("record_id").cast(kind).alias("page_id"),
            F.col("type").alias("record_type"),
            page_of("refers_to").cast(kind).alias("refers_to"),
            F.substring("digest", 6, 32).alias("stated"),
            F.length("payload").cast("long").alias("payload_bytes"),
            base32(F.sha1("payload")).alias("payload_digest"),
        )
    )
    described = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = read.filter("record_type = 'response'")
    named = responses.select(
        F.col("page_id").alias("refers_to"),
        F.col("payload_digest").alias("stated"),
        "payload_bytes",
    ).dropDuplicates(["refers_to", "stated"])
    revisits = read.filter("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    found = revisits.join(named, ["refers_to", "stated"], "left").select(
        "page_id",
        "payload_bytes",
        F.when(F.col("payload_bytes").isNotNull(), F.col("stated")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
    return responses.select(described).unionByName(found)
