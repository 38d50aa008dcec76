"""Decoding, asset joins, request generation, samples and paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.catalog.registry import query
from loadlens.catalog.views import P, predictions, table
from loadlens.functions import messages, numbers, paths, times
from loadlens.operators import assets, decode, metrics, partitions, sampling
from loadlens.plans import ingest
from loadlens.sinks.messages import as_messages
from loadlens.sources import files, offsets

_SIZES = (20, 50, 100, 200, 500, 1000)


def _messages(spark, sf_dir) -> DataFrame:
    """Well-formed request messages of all events, as bytes."""
    rows = predictions(spark, sf_dir).select(
        "file_path", "true_label", "request_id", times.iso_text("ingest_ts").alias("ingest_ts")
    )
    return as_messages(rows).select(F.col("value").cast("binary").alias("value"))


def _mixed_messages(spark, sf_dir) -> DataFrame:
    """Messages of all events where each event type is spoiled in its own way, views excepted."""
    rows = predictions(spark, sf_dir).withColumn("kind", F.split("file_path", "/")[2])
    body = (
        "CASE kind WHEN 'error' THEN concat('not json ', request_id) "
        "WHEN 'click' THEN to_json(named_struct('request_id', request_id)) "
        "WHEN 'signup' THEN to_json(named_struct('file_path', file_path, 'ingest_ts', 'x')) "
        "WHEN 'purchase' THEN to_json(named_struct('file_path', file_path, "
        "'request_id', request_id, 'ingest_ts', 'soon')) "
        "ELSE to_json(named_struct('file_path', file_path, 'true_label', true_label, "
        "'request_id', request_id, 'ingest_ts', "
        "concat(date_format(ingest_ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), 'Z'))) END"
    )
    return rows.selectExpr("request_id AS source_id", f"CAST({body} AS BINARY) AS value")


def _ingest_us(df: DataFrame) -> DataFrame:
    return df.withColumn("ingest_us", times.micros("ingest_ts")).drop("ingest_ts")


@query(
    "decode_requests",
    f"WITH {P} SELECT file_path, true_label, request_id, ingest_us FROM P",
)
def decode_requests(spark, sf_dir) -> DataFrame:
    return _ingest_us(decode.decode_requests(_messages(spark, sf_dir)))


@query(
    "decode_mixed_requests",
    f"WITH {P} SELECT file_path, true_label, request_id, ingest_us FROM P "
    "WHERE file_path LIKE '%/view/%'",
)
def decode_mixed_requests(spark, sf_dir) -> DataFrame:
    return _ingest_us(decode.decode_requests(_mixed_messages(spark, sf_dir)))


@query(
    "rejected_requests",
    f"""WITH {P}, K AS (SELECT request_id, split_part(file_path, '/', 3) AS kind FROM P)
SELECT request_id AS source_id, CASE kind WHEN 'error' THEN 'unreadable'
  WHEN 'click' THEN 'no file_path' WHEN 'signup' THEN 'no request_id'
  ELSE 'bad ingest_ts' END AS reason FROM K WHERE kind <> 'view'""",
)
def rejected_requests(spark, sf_dir) -> DataFrame:
    found = decode.rejected_requests(_mixed_messages(spark, sf_dir), keep=("source_id",))
    return found.select("source_id", "reason")


@query("decode_paths", f"WITH {P} SELECT file_path, true_label FROM P")
def decode_paths(spark, sf_dir) -> DataFrame:
    return decode.decode_paths(_messages(spark, sf_dir))


@query(
    "distinct_requests",
    f"WITH {P} SELECT request_id, file_path, true_label, ingest_us FROM P",
)
def distinct_requests(spark, sf_dir) -> DataFrame:
    """Every request twice, the copy an hour later under another path."""
    rows = predictions(spark, sf_dir).select("request_id", "file_path", "true_label", "ingest_ts")
    again = rows.withColumn("ingest_ts", F.expr("ingest_ts + INTERVAL 1 HOUR")).withColumn(
        "file_path", F.concat(F.lit("again/"), "file_path")
    )
    return _ingest_us(decode.distinct_requests(rows.unionByName(again)))


@query(
    "props_sum",
    "SELECT event_type, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS k_sum "
    "FROM events GROUP BY event_type",
)
def props_sum(spark, sf_dir) -> DataFrame:
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([StructField("k", LongType())])
    body = messages.body_struct("props", schema)
    rows = table(spark, sf_dir, "events").select("event_type", body["k"].alias("k"))
    return rows.groupBy("event_type").agg(F.sum("k").alias("k_sum"))


@query(
    "message_bodies",
    """SELECT doc_id, json_extract_string(v, '$.text') AS text,
  json_extract_string(v, '$.source') AS source
FROM (SELECT doc_id, to_json({'text': text, 'source': source}) AS v FROM documents)""",
)
def message_bodies(spark, sf_dir) -> DataFrame:
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    schema = StructType(
        [
            StructField("doc_id", LongType()),
            StructField("text", StringType()),
            StructField("source", StringType()),
        ]
    )
    sent = as_messages(docs, key="doc_id")
    return sent.select(messages.body_struct("value", schema).alias("b")).select("b.*")


# Pages as stored files, named by page; requests name them by user, spelled another way.
def _asset_requests(spark, sf_dir) -> DataFrame:
    user = F.regexp_extract("file_path", r"img_(\d+)", 1)
    rows = predictions(spark, sf_dir).withColumn("user", user.cast("bigint"))
    path = F.concat(F.lit("/data//pages/"), F.col("user") * 2, F.lit(".html"))
    return rows.select("request_id", path.alias("file_path"))


def _asset_files(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("file:///data/pages/"), "page_id", F.lit(".html")).alias("file_path"),
        F.octet_length("html").alias("length"),
        F.col("html").cast("binary").alias("content"),
    )


_ASSET_SQL = f"""{P},
Q AS (SELECT request_id, 2 * CAST(regexp_extract(file_path, 'img_(\\d+)', 1) AS BIGINT) AS page
      FROM P)"""


@query(
    "request_asset_join",
    f"WITH {_ASSET_SQL} SELECT request_id, concat('/data//pages/', page, '.html') AS file_path, "
    "concat('file:///data/pages/', page, '.html') AS asset_path, "
    "CAST(strlen(html) AS INTEGER) AS length FROM Q JOIN pages ON page_id = page",
)
def request_asset_join(spark, sf_dir) -> DataFrame:
    listing = _asset_files(spark, sf_dir).drop("content")
    return assets.match_assets(_asset_requests(spark, sf_dir), listing)


@query(
    "missing_assets",
    f"WITH {_ASSET_SQL} SELECT request_id, concat('/data//pages/', page, '.html') AS file_path "
    "FROM Q WHERE page NOT IN (SELECT page_id FROM pages)",
)
def missing_assets(spark, sf_dir) -> DataFrame:
    return assets.missing_assets(_asset_requests(spark, sf_dir), _asset_files(spark, sf_dir))


@query(
    "request_asset_content",
    f"WITH {_ASSET_SQL} SELECT request_id, md5(html) AS content_md5 "
    "FROM Q JOIN pages ON page_id = page",
)
def request_asset_content(spark, sf_dir) -> DataFrame:
    joined = assets.join_assets(_asset_requests(spark, sf_dir), _asset_files(spark, sf_dir))
    return joined.select("request_id", F.md5("content").alias("content_md5"))


# Pages as a listing of labelled files: the label is the language folder of the address.
def _page_listing(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        F.col("url").alias("file_path"), F.split("url", "/")[3].alias("true_label")
    )


_LISTING = "L AS (SELECT url AS file_path, split_part(url, '/', 4) AS true_label FROM pages)"
_NUMBERED = (
    f"{_LISTING}, N AS (SELECT *, row_number() OVER (ORDER BY true_label, file_path) - 1 AS n FROM L)"
)
_MOMENT = "2025-12-10T04:35:45.410891"


def _numbered(spark, sf_dir, limit=None) -> DataFrame:
    at = F.to_timestamp(F.lit(_MOMENT))
    return ingest.number_requests(_page_listing(spark, sf_dir), limit, at)


@query(
    "request_generation",
    f"WITH {_NUMBERED} SELECT file_path, true_label, "
    f"concat('req_', lpad(CAST(n AS VARCHAR), 8, '0')) AS request_id, '{_MOMENT}' AS ingest_ts "
    "FROM N",
)
def request_generation(spark, sf_dir) -> DataFrame:
    return _numbered(spark, sf_dir)


@query(
    "request_messages",
    f"""WITH {_NUMBERED} SELECT concat('{{"file_path":"', file_path, '","true_label":"', true_label,
  '","request_id":"req_', lpad(CAST(n AS VARCHAR), 8, '0'), '","ingest_ts":"{_MOMENT}"}}') AS value
FROM N""",
)
def request_messages(spark, sf_dir) -> DataFrame:
    return ingest.request_messages(_numbered(spark, sf_dir))


@query(
    "request_preview",
    f"""WITH {_NUMBERED} SELECT concat('{{"file_path":"', file_path, '","true_label":"', true_label,
  '","request_id":"req_', lpad(CAST(n AS VARCHAR), 8, '0'), '","ingest_ts":"{_MOMENT}"}}') AS value
FROM N WHERE n < 10""",
)
def request_preview(spark, sf_dir) -> DataFrame:
    return ingest.preview(_numbered(spark, sf_dir))


@query(
    "dense_order_numbers",
    "SELECT l_orderkey, l_linenumber, l_returnflag, l_shipdate_us, "
    "row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate_us, l_orderkey, "
    "l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS seq FROM "
    "(SELECT *, epoch_us(l_shipdate) AS l_shipdate_us FROM lineitem)",
)
def dense_order_numbers(spark, sf_dir) -> DataFrame:
    from loadlens.operators.sequence import dense_sequence

    rows = table(spark, sf_dir, "lineitem")
    rows = rows.withColumn("l_shipdate_us", times.micros("l_shipdate"))
    order = ["l_shipdate_us", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    out = dense_sequence(
        rows.select(*order, "l_extendedprice", "l_returnflag"),
        [*order, "l_extendedprice"],
        ["l_returnflag"],
    )
    return out.select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate_us", "seq")


@query(
    "manifest",
    f"""WITH {_LISTING}, K AS (SELECT *, concat('raw_images/', true_label, '/',
  split_part(file_path, '/', -1)) AS s3_key FROM L)
SELECT s3_key, concat('s3://scans/', s3_key) AS s3_uri, file_path AS local_path,
  true_label AS label FROM K""",
)
def manifest(spark, sf_dir) -> DataFrame:
    return ingest.manifest(_page_listing(spark, sf_dir), "scans")


@query(
    "balanced_sample",
    f"""WITH {P} SELECT request_id, true_label FROM P
QUALIFY row_number() OVER (PARTITION BY true_label ORDER BY file_path, request_id) <= 50""",
)
def balanced_sample(spark, sf_dir) -> DataFrame:
    rows = predictions(spark, sf_dir).select("request_id", "file_path", "true_label")
    out = sampling.balanced_sample(rows, 50, "true_label", ["file_path", "request_id"])
    return out.drop("file_path")


@query(
    "balanced_sample_large",
    f"""WITH {P} SELECT request_id, true_label FROM P
QUALIFY row_number() OVER (PARTITION BY true_label ORDER BY file_path, request_id) <= 1200""",
)
def balanced_sample_large(spark, sf_dir) -> DataFrame:
    rows = predictions(spark, sf_dir).select("request_id", "file_path", "true_label")
    out = sampling.balanced_sample(rows, 1200, "true_label", ["file_path", "request_id"])
    return out.drop("file_path")


@query(
    "balanced_sample_huge",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey,
  l_suppkey, l_extendedprice) <= 12000""",
)
def balanced_sample_huge(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    out = sampling.balanced_sample(
        rows.select(*order, "l_returnflag"), 12000, "l_returnflag", order
    )
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")


@query(
    "two_class_sample",
    f"""WITH {P} SELECT request_id, true_label FROM P WHERE true_label IN ('view', 'click')
QUALIFY row_number() OVER (PARTITION BY true_label ORDER BY file_path, request_id) <= 5""",
)
def two_class_sample(spark, sf_dir) -> DataFrame:
    rows = predictions(spark, sf_dir).select("request_id", "file_path", "true_label")
    out = sampling.two_class_sample(
        rows, 10, ("view", "click"), "true_label", ["file_path", "request_id"]
    )
    return out.drop("file_path")


_LADDER_VALUES = ", ".join(f"({i + 1}, {n})" for i, n in enumerate(_SIZES))


@query(
    "size_ladder",
    f"""WITH {P}, N AS (SELECT request_id, row_number() OVER (ORDER BY request_id) AS n FROM P),
S AS (SELECT * FROM (VALUES {_LADDER_VALUES}) AS t(i, size)
      WHERE size <= (SELECT count(*) FROM P))
SELECT request_id, concat('run_', lpad(CAST(i AS VARCHAR), 3, '0'), '_', size, 'reqs') AS run_label,
  CAST(size AS INTEGER) AS run_size FROM N JOIN S ON n <= size""",
)
def size_ladder(spark, sf_dir) -> DataFrame:
    rows = predictions(spark, sf_dir).select("request_id")
    return sampling.size_ladder(rows, _SIZES, ["request_id"])


@query(
    "first_n",
    f"WITH {P} SELECT request_id, file_path FROM P ORDER BY file_path, request_id LIMIT 20",
)
def first_n(spark, sf_dir) -> DataFrame:
    rows = predictions(spark, sf_dir).select("request_id", "file_path")
    return sampling.first_n(rows, 20, ["file_path", "request_id"])


@query(
    "first_n_huge",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 5000""",
)
def first_n_huge(spark, sf_dir) -> DataFrame:
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    out = sampling.first_n(table(spark, sf_dir, "lineitem").select(*order), 5000, order)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


@query("request_count", f"WITH {P} SELECT count(*) AS rows FROM P")
def request_count(spark, sf_dir) -> DataFrame:
    return predictions(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "task_counts",
    f"""WITH {P}, C AS (SELECT run_label, count(*) AS n FROM P GROUP BY run_label)
SELECT run_label, n, CAST(greatest(1, least(64, ceil(n / 200.0))) AS INTEGER) AS tasks FROM C""",
)
def task_counts(spark, sf_dir) -> DataFrame:
    """Tasks of 200 rows, 64 at most: the fixed values of the rule that is asked for."""
    counts = predictions(spark, sf_dir).groupBy("run_label").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("tasks", partitions.tasks_for(F.col("n"), 64))


@query(
    "union_of_samples",
    f"""WITH {P}, V AS (SELECT request_id, true_label FROM P WHERE true_label = 'view'),
C AS (SELECT request_id, true_label FROM P WHERE true_label = 'click')
SELECT * FROM V UNION ALL SELECT * FROM C""",
)
def union_of_samples(spark, sf_dir) -> DataFrame:
    rows = predictions(spark, sf_dir).select("request_id", "true_label")
    label = F.col("true_label")
    return rows.filter(label == "view").unionByName(rows.filter(label == "click"))


@query(
    "path_parts",
    r"""SELECT page_id, split_part(url, '/', -1) AS name, split_part(url, '/', -2) AS parent,
  regexp_extract(url, '^[A-Za-z0-9]+://([^/]*)', 1) AS container,
  regexp_extract(url, '^[A-Za-z0-9]+://[^/]*/(.*)$', 1) AS key,
  regexp_replace(split_part(url, '/', -1), '^(.+)\.[^.]+$', '\1') AS stem,
  lower(regexp_extract(split_part(url, '/', -1), '^.+(\.[^.]+)$', 1)) AS suffix,
  contains(lower(right(url, 5)), '.html') AS is_html FROM pages""",
)
def path_parts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id",
        paths.file_name("url").alias("name"),
        paths.parent_name("url").alias("parent"),
        paths.uri_container("url").alias("container"),
        paths.uri_key("url").alias("key"),
        paths.file_stem("url").alias("stem"),
        paths.file_suffix("url").alias("suffix"),
        paths.has_suffix("url", (".html",)).alias("is_html"),
    )


@query(
    "label_from_path",
    f"WITH {P} SELECT request_id, split_part(file_path, '/', -2) AS label FROM P",
)
def label_from_path(spark, sf_dir) -> DataFrame:
    rows = predictions(spark, sf_dir)
    return rows.select("request_id", paths.parent_name("file_path").alias("label"))


@query(
    "path_class_counts",
    f"""WITH {P}, L AS (SELECT split_part(file_path, '/', -2) AS true_label FROM P)
SELECT true_label, count(*) AS count FROM L GROUP BY true_label
UNION ALL SELECT 'TOTAL', count(*) FROM L""",
)
def path_class_counts(spark, sf_dir) -> DataFrame:
    label = paths.parent_name("file_path").alias("true_label")
    return metrics.class_counts(predictions(spark, sf_dir).select(label))


_TREE = """T AS (SELECT concat('/chest/', CASE event_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'test'
  ELSE 'val' END, '/', event_type, '/im', user_id, '.png') AS path FROM events)"""


@query(
    "flatten_splits",
    f"""WITH {_TREE} SELECT split_part(path, '/', 4) AS true_label,
  concat(split_part(path, '/', 3), '_', split_part(path, '/', 5)) AS flat_name,
  min(path) AS file_path FROM T GROUP BY 1, 2""",
)
def flatten_splits(spark, sf_dir) -> DataFrame:
    path = (
        "concat('/chest/', CASE event_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'test' ELSE 'val' "
        "END, '/', event_type, '/im', user_id, '.png') AS file_path"
    )
    return files.flatten_splits(table(spark, sf_dir, "events").selectExpr(path))


@query(
    "study_id",
    f"""WITH {P}, S AS (SELECT request_id, regexp_extract(file_path, 'img_(\\d+)', 1) AS u FROM P)
SELECT request_id, concat('IM-', lpad(u, 4, '0')) AS study_id,
  concat('CXR-TRAIN-IM-', lpad(u, 4, '0')) AS case_id FROM S""",
)
def study_id(spark, sf_dir) -> DataFrame:
    user = F.lpad(F.regexp_extract("file_path", r"img_(\d+)", 1), 4, "0")
    path = F.concat(F.lit("/scans/im-"), user, F.lit("-0001.jpeg"))
    rows = predictions(spark, sf_dir).select("request_id", path.alias("file_path"))
    return rows.select(
        "request_id",
        paths.study_id("file_path").alias("study_id"),
        paths.case_id("file_path").alias("case_id"),
    )


@query(
    "short_device",
    f"WITH {P} SELECT request_id, split_part(gpu_used, '-', 1) AS device FROM P",
)
def short_device(spark, sf_dir) -> DataFrame:
    rows = predictions(spark, sf_dir)
    return rows.select("request_id", paths.short_device("gpu_used").alias("device"))


@query(
    "iso_parse",
    f"""WITH {P} SELECT request_id, CASE batch_size WHEN 4 THEN NULL
  WHEN 3 THEN ingest_us - 7200000000 ELSE ingest_us END AS parsed_us,
  CASE batch_size WHEN 4 THEN NULL
  WHEN 3 THEN (dequeue_us - ingest_us + 7200000000) / 1000.0
  ELSE (dequeue_us - ingest_us) / 1000.0 END AS wait_ms FROM P""",
)
def iso_parse(spark, sf_dir) -> DataFrame:
    """Naive, Z, offset and unreadable time texts in turn."""
    iso = times.iso_text("ingest_ts")
    text = (
        F.when(F.col("batch_size") == 1, iso)
        .when(F.col("batch_size") == 2, F.concat(F.lit(" "), iso, F.lit("Z ")))
        .when(F.col("batch_size") == 3, F.concat(iso, F.lit("+02:00")))
        .otherwise(F.concat(F.lit("about "), iso))
    )
    parsed = times.parse_iso(text)
    return predictions(spark, sf_dir).select(
        "request_id",
        F.unix_micros(parsed).alias("parsed_us"),
        times.elapsed_ms(parsed, "dequeue_ts").alias("wait_ms"),
    )


@query(
    "iso_parse_odd",
    f"""WITH {P} SELECT request_id, CASE batch_size WHEN 4 THEN dequeue_us - dequeue_us % 86400000000
  WHEN 3 THEN dequeue_us END AS parsed_us,
  strftime(make_timestamp(dequeue_us), '%Y-%m-%dT%H:%M:%S.%f') AS written FROM P""",
)
def iso_parse_odd(spark, sf_dir) -> DataFrame:
    """A bare time, a bare year, a zone-less text and a bare date in turn."""
    iso = times.iso_text("dequeue_ts")
    text = (
        F.when(F.col("batch_size") == 1, F.substring(iso, 11, 9))
        .when(F.col("batch_size") == 2, F.substring(iso, 1, 4))
        .when(F.col("batch_size") == 3, iso)
        .otherwise(F.substring(iso, 1, 10))
    )
    return predictions(spark, sf_dir).select(
        "request_id", F.unix_micros(times.parse_iso(text)).alias("parsed_us"), iso.alias("written")
    )


@query(
    "date_texts",
    f"""WITH {P} SELECT request_id, strftime(make_timestamp(ingest_us), '%B %d, %Y') AS day,
  strftime(make_timestamp(ingest_us), '%Y%m%d_%H%M%S') AS stamp FROM P""",
)
def date_texts(spark, sf_dir) -> DataFrame:
    return predictions(spark, sf_dir).select(
        "request_id",
        times.long_date("ingest_ts").alias("day"),
        times.run_stamp("ingest_ts").alias("stamp"),
    )


@query(
    "latency_class",
    """SELECT o_orderkey, CASE WHEN o_totalprice / 20 < 5000 THEN 'fast'
  WHEN o_totalprice / 20 < 15000 THEN 'medium' ELSE 'slow' END AS latency_class,
  CAST(CASE WHEN o_totalprice / 3000 >= 80 THEN 8 WHEN o_totalprice / 3000 >= 40 THEN 4
  WHEN o_totalprice / 3000 >= 24 THEN 2 ELSE 1 END AS INTEGER) AS micro_batch,
  round(CASE WHEN o_totalprice > 0 THEN 1.0 / (o_totalprice / 20 / 1000) ELSE 0 END, 6) AS rate
FROM orders""",
)
def latency_class(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumn("ms", F.col("o_totalprice") / 20)
    return rows.select(
        "o_orderkey",
        numbers.latency_class("ms").alias("latency_class"),
        numbers.micro_batch_for_memory(F.col("o_totalprice") / 3000).alias("micro_batch"),
        F.round(numbers.rate_of(F.col("ms") / 1000), 6).alias("rate"),
    )


# Four topic partitions; some offsets are missing and some were read twice or three times.
def _read_messages(spark, sf_dir) -> DataFrame:
    n = F.col("event_id")
    times = F.when(n % 1000 < 40, 0).when(n % 300 < 20, 2 + n % 2).otherwise(1).cast("int")
    rows = table(spark, sf_dir, "events").withColumn("_copy", F.explode(F.array_repeat(F.lit(0), times)))
    return rows.select(
        F.lit("requests").alias("topic"), (n % 4).cast("int").alias("partition"), F.expr("event_id div 4").alias("offset")
    )


_MESSAGES = """M AS (SELECT 'requests' AS topic, CAST(event_id % 4 AS INTEGER) AS partition, event_id // 4 AS pos,
  CASE WHEN event_id % 1000 < 40 THEN 0 WHEN event_id % 300 < 20 THEN 2 + event_id % 2 ELSE 1 END AS times FROM events),
R AS (SELECT *, pos - row_number() OVER (PARTITION BY partition ORDER BY pos) AS run FROM M WHERE times > 0),
I AS (SELECT topic, partition, min(pos) AS first, max(pos) AS last FROM R GROUP BY topic, partition, run)"""


@query("offset_ranges", f"WITH {_MESSAGES} SELECT * FROM I")
def offset_ranges(spark, sf_dir) -> DataFrame:
    return offsets.read_ranges(_read_messages(spark, sf_dir))


@query(
    "offset_gaps",
    f"""WITH {_MESSAGES}, G AS (SELECT *, pos - row_number() OVER (PARTITION BY partition ORDER BY pos) AS run
  FROM M WHERE times = 0)
SELECT topic, partition, min(pos) AS first, max(pos) AS last FROM G GROUP BY topic, partition, run""",
)
def offset_gaps(spark, sf_dir) -> DataFrame:
    """What a reader of all offsets missed, the beginning and the end of each partition included."""
    ends = table(spark, sf_dir, "events").groupBy((F.col("event_id") % 4).cast("int").alias("partition"))
    ends = ends.agg((F.max(F.expr("event_id div 4")) + 1).alias("end"))
    expected = ends.select(F.lit("requests").alias("topic"), "partition", F.lit(0).cast("bigint").alias("start"), "end")
    return offsets.missing_ranges(offsets.read_ranges(_read_messages(spark, sf_dir)), expected)


@query(
    "offset_repeats",
    f"""WITH {_MESSAGES}, D AS (SELECT *, pos - row_number() OVER (PARTITION BY partition, times ORDER BY pos) AS run
  FROM M WHERE times > 1)
SELECT topic, partition, min(pos) AS first, max(pos) AS last, times FROM D GROUP BY topic, partition, times, run""",
)
def offset_repeats(spark, sf_dir) -> DataFrame:
    return offsets.repeated_ranges(_read_messages(spark, sf_dir))


@query(
    "offset_resume",
    f"""WITH {_MESSAGES}, E AS (SELECT topic, partition, min(first) AS f, arg_min(last, first) AS l FROM I GROUP BY ALL),
N AS (SELECT topic, partition, l + 1 AS next FROM E)
SELECT partition, count(*) AS still_to_read FROM M JOIN N USING (topic, partition) WHERE pos >= next GROUP BY partition""",
)
def offset_resume(spark, sf_dir) -> DataFrame:
    """How many messages lie at or beyond the first gap, where a reader goes on."""
    ranges = offsets.read_ranges(_read_messages(spark, sf_dir))
    resume = offsets.resume_offsets(ranges, offsets.missing_ranges(ranges))
    n = F.col("event_id")
    every = table(spark, sf_dir, "events").select(
        F.lit("requests").alias("topic"), (n % 4).cast("int").alias("partition"), F.expr("event_id div 4").alias("offset")
    )
    return offsets.beyond(every, resume).groupBy("partition").agg(F.count(F.lit(1)).alias("still_to_read"))
