"""Every sink written and read back, and file listings over written trees."""

from __future__ import annotations

import contextlib
from itertools import islice

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.catalog.metrics import _stats
from loadlens.catalog.registry import query
from loadlens.catalog.requests import _page_listing
from loadlens.catalog.views import P, predictions, table
from loadlens.functions import times
from loadlens.operators import assets, metrics, scoring
from loadlens.plans import ingest, job
from loadlens.scratch import discard, scratch_path
from loadlens.sinks import files as sinks
from loadlens.sinks import snapshots
from loadlens.sources import files, tables
from loadlens.sources.dispatch import SourceSpec, load_requests

_PREDICTIONS = f"""WITH {P} SELECT request_id, file_path, true_label, ingest_us, queue_wait_ms,
  inference_time_ms, batch_size, error_message, run_label FROM P"""
_COLUMNS = [
    "request_id",
    "file_path",
    "true_label",
    "ingest_us",
    "queue_wait_ms",
    "inference_time_ms",
    "batch_size",
    "error_message",
    "run_label",
]


#: Pages in one file of a written tree, and entries in one array of a manifest, at most.
FILE_PAGES, ARRAY_ENTRIES = 200, 1_000

#: Bytes of a block of lines that a digest is made from, about; an Arrow batch has 10,000 of them.
BLOCK_BYTES = 4_096
_BLOCK = "split string, label string, piece int, text binary, error_message string"

#: Bytes of lines that are sorted together, about; cuts between such pieces, and characters of a cut, at most.
PIECE_BYTES, MOST_CUTS, CUT_CHARS = 2 << 20, 1_000, 16_384


def _rows(spark, sf_dir) -> DataFrame:
    rows = predictions(spark, sf_dir).withColumn("ingest_us", times.micros("ingest_ts"))
    return rows.select(*_COLUMNS)


@query("predictions_parquet", _PREDICTIONS)
def predictions_parquet(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "predictions")
    rows = _rows(spark, sf_dir)
    sinks.write_parquet(rows, path, ["run_label"])
    return spark.read.schema(rows.schema).parquet(path)


@query("predictions_csv", _PREDICTIONS)
def predictions_csv(spark, sf_dir) -> DataFrame:
    rows = _rows(spark, sf_dir)
    written = sinks.write_predictions(rows, scratch_path(spark, "predictions"), ["csv"])
    return tables.read_csv(spark, written["csv"], rows.schema)


@query("predictions_json", _PREDICTIONS)
def predictions_json(spark, sf_dir) -> DataFrame:
    rows = _rows(spark, sf_dir)
    written = sinks.write_predictions(rows, scratch_path(spark, "predictions"), ["json"])
    return spark.read.schema(rows.schema).json(written["json"])


@query("multiline_csv", "SELECT doc_id, text, lang FROM documents")
def multiline_csv(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "texts")
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    sinks.write_csv(rows, path)
    return tables.read_csv(spark, path, rows.schema)


@query(
    "predictions_by_class",
    f"WITH {P} SELECT true_label, count(*) AS rows, sum(inference_time_ms) > 0 AS busy "
    "FROM P GROUP BY true_label",
)
def predictions_by_class(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "by-class")
    rows = predictions(spark, sf_dir).select("request_id", "inference_time_ms", "true_label")
    sinks.write_parquet(rows, path, ["true_label"])
    stored = spark.read.schema(rows.schema).parquet(path)
    return stored.groupBy("true_label").agg(
        F.count(F.lit(1)).alias("rows"), (F.sum("inference_time_ms") > 0).alias("busy")
    )


@query(
    "metric_csv",
    f"WITH {P} SELECT run_label, {_stats('queue_wait_ms')} FROM P "
    "WHERE error_message IS NULL GROUP BY run_label",
)
def metric_csv(spark, sf_dir) -> DataFrame:
    """A metric table written to two targets; the second one read back."""
    stats = metrics.latency_stats(predictions(spark, sf_dir), "queue_wait_ms", ["run_label"])
    targets = [scratch_path(spark, f"metrics-{i}") for i in (1, 2)]
    sinks.write_metrics({"queue_wait_stats": stats}, targets)
    return tables.read_csv(spark, f"{targets[1]}/queue_wait_stats", stats.schema)


@query(
    "manifest_requests",
    "SELECT url AS file_path, split_part(url, '/', 4) AS true_label FROM pages",
)
def manifest_requests(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "manifest")
    sinks.write_manifest(ingest.manifest(_page_listing(spark, sf_dir), "scans"), path)
    return tables.read_manifest(spark, path, "lines")


_MANIFEST = "SELECT url AS file_path, split_part(url, '/', 4) AS true_label FROM pages"


@query("manifest_lines", _MANIFEST)
def manifest_lines(spark, sf_dir) -> DataFrame:
    """The manifest as it is written, through the dispatcher."""
    path = scratch_path(spark, "manifest")
    sinks.write_manifest(ingest.manifest(_page_listing(spark, sf_dir), "scans"), path)
    return load_requests(spark, SourceSpec(manifest=path))


@query("manifest_array", _MANIFEST)
def manifest_array(spark, sf_dir) -> DataFrame:
    """One JSON array per file, through the dispatcher. A file holds ``ARRAY_ENTRIES`` of a site at most."""
    path = scratch_path(spark, "manifest")
    entries = ingest.manifest(_page_listing(spark, sf_dir), "scans").select(
        F.substring_index("local_path", "/", 3).alias("site"), F.struct("*").alias("entry")
    )
    # Row numbers with gaps, so that a bucket holds so many rows at most, however many a site has.
    bucket = F.floor(F.monotonically_increasing_id() / ARRAY_ENTRIES)
    arrays = entries.withColumn("bucket", bucket).groupBy("site", "bucket")
    arrays = arrays.agg(F.to_json(F.collect_list("entry")).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return load_requests(spark, SourceSpec(manifest=path))


def _page_tree(spark, sf_dir, wanted: str = "true") -> str:
    """Pages written as text files in one folder per split and language."""
    path = scratch_path(spark, "pages")
    pages = table(spark, sf_dir, "pages").filter(wanted).selectExpr(
        "html", "CASE page_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'test' ELSE 'val' END AS split",
        "split_part(url, '/', 4) AS label",
    )
    # Every task writes what it reads, so no folder is written by one task or into one file.
    pages.write.option("maxRecordsPerFile", FILE_PAGES).partitionBy("split", "label").text(path)
    return path


_TREE = """SELECT concat('split=', CASE page_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'test' ELSE 'val' END)
  AS split, concat('label=', split_part(url, '/', 4)) AS label,
  CAST(sum(strlen(html) + 1) AS BIGINT) AS bytes FROM pages GROUP BY 1, 2"""


def _by_folder(listing: DataFrame, size) -> DataFrame:
    folder = F.split("file_path", "/")
    return listing.groupBy(
        F.element_at(folder, -3).alias("split"), F.element_at(folder, -2).alias("label")
    ).agg(F.sum(size).alias("bytes"))


@query("asset_listing", _TREE)
def asset_listing(spark, sf_dir) -> DataFrame:
    listing = files.list_assets(spark, _page_tree(spark, sf_dir), (".TXT",))
    return _by_folder(listing, F.col("file_size_bytes"))


@query("asset_content", _TREE)
def asset_content(spark, sf_dir) -> DataFrame:
    content = files.read_assets(spark, _page_tree(spark, sf_dir), (".txt",))
    return _by_folder(content, F.octet_length("content").cast("bigint"))


@query("asset_fetch", _TREE)
def asset_fetch(spark, sf_dir) -> DataFrame:
    """Bytes read by path inside the tasks, without moving any."""
    listing = files.list_assets(spark, _page_tree(spark, sf_dir), (".txt",))
    fetched = assets.fetch_content(listing.select("file_path"), "file_path")
    fetched = fetched.filter("fetch_error IS NULL")
    return _by_folder(fetched, F.octet_length("content").cast("bigint"))


@query(
    "labelled_tree",
    "SELECT DISTINCT concat('label=', split_part(url, '/', 4)) AS true_label FROM pages",
)
def labelled_tree(spark, sf_dir) -> DataFrame:
    tree = files.list_labelled(spark, _page_tree(spark, sf_dir), suffixes=(".txt",))
    return tree.select("true_label").distinct()


@query("unlabelled_listing", _TREE.replace("concat('label=', split_part(url, '/', 4))", "CAST(NULL AS VARCHAR)"))
def unlabelled_listing(spark, sf_dir) -> DataFrame:
    """A store without labels, through the dispatcher; sizes from the listing beside it."""
    tree = _page_tree(spark, sf_dir)
    found = load_requests(spark, SourceSpec(object_store=tree, suffixes=(".txt",)))
    sizes = files.list_assets(spark, tree, (".txt",)).select("file_path", "file_size_bytes")
    folder = F.element_at(F.split("file_path", "/"), -3).alias("split")
    return (
        found.join(sizes, "file_path")
        .groupBy(folder, F.col("true_label").alias("label"))
        .agg(F.sum("file_size_bytes").alias("bytes"))
    )


@query("view_by_name", f"WITH {P} SELECT run_label, count(*) AS rows FROM P GROUP BY run_label")
def view_by_name(spark, sf_dir) -> DataFrame:
    sinks.register_view(predictions(spark, sf_dir), "predictions_by_name")
    return spark.sql("SELECT run_label, count(*) AS rows FROM predictions_by_name GROUP BY run_label")


@query(
    "optional_csv",
    "SELECT lang, count(*) AS rows FROM documents GROUP BY lang",
)
def optional_csv(spark, sf_dir) -> DataFrame:
    """A side table that exists and one that does not."""
    path = scratch_path(spark, "side")
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang")
    sinks.write_csv(rows, path)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType())])
    found = tables.read_optional_csv(spark, path, schema)
    absent = tables.read_optional_csv(spark, f"{path}-absent", schema)
    return found.unionByName(absent).groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))


def _sorted_lines(model: None, rows) -> list[str]:
    """A stand-in scorer that reads the file: its lines in order."""
    return [
        b"\n".join(sorted(bytes(content).split(b"\n")[:-1])).decode() for content in rows["content"]
    ]


_FILES = """L AS (SELECT concat('split=', CASE page_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'test'
  ELSE 'val' END) AS split, concat('label=', split_part(url, '/', 4)) AS label,
  unnest(string_split(html, chr(10))) AS line FROM pages),
T AS (SELECT split, label, md5(string_agg(line, chr(10) ORDER BY line COLLATE "binary")) AS digest
  FROM L GROUP BY ALL)"""


def _content_requests(spark, sf_dir):
    tree = _page_tree(spark, sf_dir, "html IS NOT NULL")  # without a text there is no line, not an empty one
    listing = files.list_assets(spark, tree, (".txt",))
    requests = listing.select(
        "file_path",
        F.element_at(F.split("file_path", "/"), -2).alias("true_label"),
        F.concat(F.lit("req_"), F.crc32(F.col("file_path").cast("binary"))).alias("request_id"),
        F.current_timestamp().alias("ingest_ts"),
    )
    return requests, listing, tree


def _with_pieces(lines: DataFrame, total: int) -> DataFrame:
    """Lines with the ``piece`` of their folder; those of a piece come before those of the next one.

    Folders are cut at lines drawn by their bytes of ``total``. Equal lines are told apart by ``place``,
    so a frequent one is cut too. Wherever the cuts fall the order is the same; only they are broadcast,
    and no line is sent to the driver but the starts of those drawn.
    """
    cuts = max(1, min(MOST_CUTS, total // PIECE_BYTES))
    drawn = lines.filter(F.rand(42) * F.lit(total) < (F.octet_length("line") + 1) * F.lit(cuts))
    order = Window.partitionBy("_split", "_label").orderBy("_line", "_place")
    starts = drawn.select(
        F.col("split").alias("_split"),
        F.col("label").alias("_label"),
        F.substring("line", 1, CUT_CHARS).alias("_line"),
        F.col("place").alias("_place"),
    )
    starts = starts.select(
        "*",
        F.row_number().over(order).alias("_piece"),
        F.lead("_line").over(order).alias("_end_line"),
        F.lead("_place").over(order).alias("_end_place"),
    )

    def before(line: str, place: str):
        same = (F.col("line") == F.col(line)) & (F.col("place") < F.col(place))
        return (F.col("line") < F.col(line)) | same

    here = (F.col("split") == F.col("_split")) & (F.col("label") == F.col("_label"))
    last = F.col("_end_line").isNull()
    here = here & ~before("_line", "_place") & (last | before("_end_line", "_end_place"))
    found = lines.join(F.broadcast(starts), here, "left")
    return found.select(*lines.columns, F.coalesce("_piece", F.lit(0)).alias("piece"))


def _rows_of(batches, at_once: int = 250):
    """The rows of Arrow batches, of which a few at a time are Python's."""
    for batch in batches:
        for start in range(0, batch.num_rows, at_once):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, at_once).columns), strict=True)


def _blocks_of(batches, size: int):
    """Lines in order, joined to texts of ``size`` bytes and one more line of one piece at most."""
    piece, parts, held = None, [], 0
    for *of, line, error in _rows_of(batches):
        if parts and (of != piece or held >= size):
            yield *piece, b"".join(parts), None
            parts, held = [], 0
        piece = of
        if error is not None:
            yield *piece, b"", error
            continue
        parts.append(line.encode() + b"\n")
        held += len(parts[-1])
    if parts:
        yield *piece, b"".join(parts), None


def _line_blocks(size: int):
    def blocks(batches):
        import pyarrow as pa

        names = [n.split()[0] for n in _BLOCK.split(", ")]
        types = [pa.string(), pa.string(), pa.int32(), pa.binary(), pa.string()]
        made = _blocks_of(batches, size)
        while rows := list(islice(made, 256)):
            columns = [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return blocks


def _digests(batches):
    """``split, label, digest, error_message`` of each folder from its blocks in order, one at a time."""
    import hashlib

    import pyarrow as pa

    def made():
        digest.update(end[:-1])  # no line end after the last line
        values = [*folder, None if errors else digest.hexdigest(), min(errors, default=None)]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], pa.string()) for v in values], ["split", "label", "digest", "error_message"]
        )

    folder, digest, errors, end = None, hashlib.md5(), set(), b""
    for split, label, text, error in _rows_of(batches):
        if (split, label) != folder:
            if folder is not None:
                yield made()
            folder, digest, errors, end = (split, label), hashlib.md5(), set(), b""
        if error is not None:
            errors.add(error)
            continue
        digest.update(end)
        end = text
    if folder is not None:
        yield made()


def _folder(place: int):
    """The ``column=value`` that a folder of a written tree stands for; an empty value has a name of its own."""
    name = F.element_at(F.split("file_path", "/"), place)
    name = F.regexp_replace(name, "=__HIVE_DEFAULT_PARTITION__$", "=")
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def _scored_files(pred: DataFrame) -> DataFrame:
    """The digest of all lines of each folder in order, from the stored scores of its files.

    A folder with a file that failed has the error instead. Lines are sorted by piece over all tasks and
    joined to blocks there. Only the MD5 itself is made in sequence, by one task a folder that holds a
    batch of blocks at a time. ``pred`` is read three times: for its bytes, the cuts and the lines.
    """
    lines = pred.select(
        _folder(-3).alias("split"),
        _folder(-2).alias("label"),
        "file_path",
        F.posexplode(F.split("report_text", "\n", -1)).alias("place", "line"),
        "error_message",
    )
    lines = lines.select(
        "split", "label", "line", "error_message", F.xxhash64("file_path", "place").alias("place")
    )
    total = pred.agg(F.sum(F.octet_length("report_text") + F.lit(1))).first()[0] or 0
    pieces = _with_pieces(lines, total).drop("place").repartition("split", "label", "piece")
    pieces = pieces.sortWithinPartitions("split", "label", "piece", "line")
    pieces = pieces.select("split", "label", "piece", "line", "error_message")
    blocks = pieces.mapInArrow(_line_blocks(BLOCK_BYTES), _BLOCK)
    blocks = blocks.withColumn("place", F.monotonically_increasing_id())
    dealt = blocks.repartition("split", "label").sortWithinPartitions("split", "label", "piece", "place")
    return dealt.drop("piece", "place").mapInArrow(
        _digests, "split string, label string, digest string, error_message string"
    )


_SCORED = f"WITH {_FILES} SELECT split, label, digest, CAST(NULL AS VARCHAR) AS error_message FROM T"


@query("score_content", _SCORED)
def score_content(spark, sf_dir) -> DataFrame:
    """Requests matched to a listing, their bytes read in the scoring tasks, scored once and stored."""
    requests, listing, tree = _content_requests(spark, sf_dir)
    found = job.with_content(requests, listing, spark.sparkContext.defaultParallelism)
    scored, stored = scoring.score(found, scoring.Scorer(_sorted_lines), ["content"]), scratch_path(spark, "scored")
    sinks.write_parquet(scored, stored)
    discard(spark, tree)
    return _scored_files(spark.read.schema(scored.schema).parquet(stored))


@query("load_test_content", _SCORED)
def load_test_content(spark, sf_dir) -> DataFrame:
    """The same as a whole load test, read back from its predictions."""
    requests, listing, tree = _content_requests(spark, sf_dir)
    test = job.LoadTest(scratch_path(spark, "job"))
    made = job.run_load_test(requests, scoring.Scorer(_sorted_lines), test, listing)
    discard(spark, tree)
    return _scored_files(made["predictions"])


def _sized_test(spark, sf_dir, root: str, sizes) -> dict:
    requests = predictions(spark, sf_dir).select(
        "request_id", "file_path", "true_label", "ingest_ts", "inference_time_ms"
    )
    test = job.LoadTest(root, sizes, inputs=["inference_time_ms"], formats=["parquet"])
    return job.run_load_test(requests, scoring.Scorer(_cents), test)


def _cents(model: None, rows) -> list[str]:
    return [str(round(ms * 100)) for ms in rows["inference_time_ms"].tolist()]


_RUNS = f"""{P}, N AS (SELECT *, row_number() OVER (ORDER BY request_id) AS n FROM P),
S AS (SELECT * FROM (VALUES (1, 10), (2, 20)) AS t(i, size)),
Q AS (SELECT concat('run_', lpad(CAST(i AS VARCHAR), 3, '0'), '_', size, 'reqs') AS run_label,
  strlen(CAST(CAST(round(inference_time_ms * 100) AS BIGINT) AS VARCHAR)) AS chars
  FROM N JOIN S ON n <= size)"""


@query(
    "load_test_twice",
    f"""WITH {_RUNS} SELECT run_label, count(*) AS num_requests, count(*) AS success_count,
  CAST(0 AS BIGINT) AS error_count FROM Q GROUP BY run_label""",
)
def load_test_twice(spark, sf_dir) -> DataFrame:
    """A second test in one root: the summary knows its own runs only."""
    root = scratch_path(spark, "job")
    _sized_test(spark, sf_dir, root, [30])
    summary = _sized_test(spark, sf_dir, root, [10, 20])["load_test_summary"]
    return summary.select("run_label", "num_requests", "success_count", "error_count")


@query(
    "load_test_tables",
    f"""WITH {_RUNS} SELECT run_label, round(avg(chars), 2) AS mean_chars,
  CAST(min(chars) AS DOUBLE) AS min_chars, CAST(max(chars) AS DOUBLE) AS max_chars,
  CAST(quantile_disc(chars, 0.5) AS DOUBLE) AS p50_chars,
  CAST(quantile_disc(chars, 0.95) AS DOUBLE) AS p95_chars,
  count(*) AS total_requests, CAST(1 AS BIGINT) AS num_gpus, 'Success' AS status,
  count(*) AS count, 100.0 AS percentage FROM Q GROUP BY run_label""",
)
def load_test_tables(spark, sf_dir) -> DataFrame:
    """The tables of the job that no clock decides, side by side."""
    made = _sized_test(spark, sf_dir, scratch_path(spark, "job"), [10, 20])
    rates = made["throughput_metrics"].select("run_label", "total_requests", "num_gpus")
    out = made["report_length_statistics"].join(rates, "run_label")
    return out.join(made["error_statistics"], "run_label")


@query(
    "sample_test",
    f"""WITH {P}, S AS (SELECT * FROM P WHERE true_label IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY true_label ORDER BY file_path, request_id) <= 5)
SELECT false AS s3_enabled, true AS kafka_enabled, count(*) AS total_images,
  count(*) AS success_count, CAST(0 AS BIGINT) AS error_count FROM S""",
)
def sample_test(spark, sf_dir) -> DataFrame:
    """The balanced-sample job: sample, score, sum up."""
    rows = predictions(spark, sf_dir).select(
        "request_id", "file_path", "true_label", "ingest_ts", "inference_time_ms"
    )
    made = job.run_sample_test(
        rows.filter("true_label IS NOT NULL"),
        scoring.Scorer(_cents),
        scratch_path(spark, "job"),
        5,
        inputs=["inference_time_ms"],
        from_topic=True,
    )["demo_summary"]
    return made.select("s3_enabled", "kafka_enabled", "total_images", "success_count", "error_count")


@query(
    "published_test",
    f"""WITH {_RUNS} SELECT run_label, count(*) AS num_requests, true AS as_before, 2 AS versions
FROM Q GROUP BY run_label""",
)
def published_test(spark, sf_dir) -> DataFrame:
    """A test, then one that breaks after its runs: readers find the first, whole and unchanged."""
    root = scratch_path(spark, "job")
    _sized_test(spark, sf_dir, root, [10, 20])
    first = snapshots.current(spark, root)

    def broken(version: str) -> None:
        snapshots.read_published(spark, root, "predictions").limit(3).write.parquet(f"{version}/predictions")
        raise RuntimeError("the driver is lost")

    with contextlib.suppress(RuntimeError):
        snapshots.publish(spark, root, broken)
    same = snapshots.current(spark, root) == first
    found = snapshots.read_published(spark, root, "predictions").groupBy("run_label")
    folders = files_of(spark, f"{root}/versions")
    return found.agg(F.count(F.lit(1)).alias("num_requests")).select(
        "run_label", "num_requests", F.lit(same).alias("as_before"), F.lit(folders).alias("versions")
    )


def files_of(spark, folder: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return len(path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path))
