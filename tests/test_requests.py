from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loadlens.functions import messages, numbers, paths, times
from loadlens.operators import assets, decode
from loadlens.plans import ingest
from loadlens.sources import files, tables, topics
from loadlens.sources.dispatch import SourceSpec, load_requests
from tests.helpers import MOMENT, plan, rows

TS = "2025-12-10T04:35:45.410891"


def bodies(spark, texts):
    data = [(None if t is None else bytearray(t.encode()),) for t in texts]
    return spark.createDataFrame(data, "value binary")


GOOD = f'{{"file_path":"a","request_id":"r1","ingest_ts":"{TS}"}}'
BAD = [
    '{"request_id":"r1"}',
    "not json",
    '{"file_path":5,"request_id":null}',
    None,
    '{"file_path":"a","request_id":"r1","ingest_ts":"garbage"}',
]


def test_decode(spark):
    got = rows(decode.decode_requests(bodies(spark, [GOOD, *BAD, GOOD])))
    assert got == [("a", None, "r1", MOMENT)] * 2


def test_rejects_are_the_rest(spark):
    got = rows(decode.rejected_requests(bodies(spark, [GOOD, *BAD])))
    assert sorted(r[1] for r in got) == [
        "bad ingest_ts",
        "no file_path",
        "no request_id",
        "unreadable",
        "unreadable",
    ]


def test_paths_only(spark):
    got = rows(decode.decode_paths(bodies(spark, [GOOD, *BAD])))
    assert sorted(got) == [("5", None), ("a", None), ("a", None)]


def test_body_is_parsed_once(spark):
    text = plan(decode.decode_requests(bodies(spark, [GOOD])))
    assert text.count("from_json") == 1


def test_earliest_of_an_id(spark):
    late = datetime(2025, 12, 11)
    data = [("r1", "b", "L", late), ("r1", "c", None, MOMENT), ("r1", "a", None, MOMENT), ("r2", "z", None, late)]
    df = spark.createDataFrame(data, "request_id string, file_path string, true_label string, ingest_ts timestamp")
    got = rows(decode.distinct_requests(df), "request_id")
    assert got == [("r1", "a", None, MOMENT), ("r2", "z", None, late)]


@pytest.mark.parametrize(
    "text,want",
    [
        (TS, MOMENT),
        (TS + "Z", MOMENT),
        ("2025-12-10T06:35:45.410891+02:00", MOMENT),
        (f"  {TS} ", MOMENT),
        (TS.replace("T", " ") + " UTC", MOMENT),
        ("2025-12-10", datetime(2025, 12, 10)),
        ("12:30", None),
        ("T07:00:00", None),
        ("2025", None),
        ("2025-12", None),
        ("garbage", None),
        ("", None),
        (None, None),
    ],
)
def test_iso(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    parsed = df.select(F.unix_micros(times.parse_iso("t")))
    want = want and round((want - datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert df.select(F.unix_micros(times.parse_iso("t"))).first()[0] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert parsed.first()[0] == want


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_texts_are_utc_in_any_zone(spark, zone):
    # Half past two does not exist on that day in New York.
    df = spark.sql("SELECT timestamp_micros(1741487400000001L) AS t, TIMESTAMP_NTZ'2025-03-09 02:30:00.000001' AS n")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = df.select(
            times.iso_text("t"), times.long_date("t"), times.run_stamp("t"),
            F.unix_micros(times.from_ntz("n")),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    want = ("2025-03-09T02:30:00.000001", "March 09, 2025", "20250309_023000", 1741487400000001)
    assert tuple(got) == want


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "path,want",
    [
        ("/data/a.png", "/data/a.png"),
        ("file:/data/a.png", "/data/a.png"),
        ("file:///data//a.png", "/data/a.png"),
        (" /data/a.png ", "/data/a.png"),
        ("s3a://b/k//x.png", "s3://b/k//x.png"),
        ("hdfs://nn/a//b", "hdfs://nn/a//b"),
        ("s3n://b/k", "s3://b/k"),
        ("hdfs://nn:8020/a", "hdfs://nn:8020/a"),
    ],
)
def test_one_spelling(spark, path, want):
    assert one(spark, paths.normalize_path(F.lit(path))) == want


def test_path_parts(spark):
    p = F.lit("s3://bucket/raw/NORMAL/IM-0545-0001.JPEG")
    assert one(spark, paths.file_name(p)) == "IM-0545-0001.JPEG"
    assert one(spark, paths.parent_name(p)) == "NORMAL"
    assert one(spark, paths.parent_name(F.lit("x"), 3)) is None
    assert one(spark, paths.file_suffix(p)) == ".jpeg"
    assert one(spark, paths.file_stem(F.lit("/a/.hidden"))) == ".hidden"
    assert one(spark, paths.uri_container(p)) == "bucket"
    assert one(spark, paths.uri_key(p)) == "raw/NORMAL/IM-0545-0001.JPEG"
    assert one(spark, paths.study_id(p)) == "IM-0545"
    assert one(spark, paths.case_id(F.lit("/a/im-7.png"))) == "CXR-TRAIN-IM-7"
    assert one(spark, paths.has_suffix(p)) and not one(spark, paths.has_suffix(p, ignore_case=False))


def test_made_up_study_ids_are_stable(spark):
    import zlib

    want = f"STUDY-{zlib.crc32(b'scan') % 100000:05d}"
    assert one(spark, paths.study_id(F.lit("/a/scan.png"))) == want


def test_numbers(spark):
    df = spark.createDataFrame([(4999.0,), (5000.0,), (15000.0,), (None,)], "ms double")
    assert [r[0] for r in df.select(numbers.latency_class("ms")).collect()] == ["fast", "medium", "slow", None]
    sizes = spark.createDataFrame([(80.0,), (79.2,), (24.0,), (8.0,)], "gb double")
    assert [r[0] for r in sizes.select(numbers.micro_batch_for_memory("gb")).collect()] == [8, 4, 2, 1]
    assert one(spark, numbers.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, numbers.rate_of(F.lit(0.0))) == 0.0
    assert one(spark, messages.embedded(F.lit(b"x" * 100))).count("\n") == 0


@pytest.fixture
def tree(tmp_path):
    for split in ("train", "test", "val"):
        for label in ("NORMAL", "PNEUMONIA"):
            folder = tmp_path / split / label
            folder.mkdir(parents=True)
            for i, suffix in enumerate(("png", "jpg", "jpeg", "PNG", "txt")):
                (folder / f"name{i}.{suffix}").write_bytes(b"x" * (i % 3 + 1))
    return tmp_path


def test_tree_scan(spark, tree):
    df = files.list_labelled(spark, str(tree))
    assert df.count() == 24 and rows(df.groupBy("true_label").count(), "true_label") == [
        ("NORMAL", 12),
        ("PNEUMONIA", 12),
    ]
    assert files.list_labelled(spark, str(tree), ["NORMAL"]).count() == 12
    assert files.list_unlabelled(spark, str(tree)).count() == 6
    assert dict(files.list_unlabelled(spark, str(tree)).dtypes)["true_label"] == "string"
    assert files.read_assets(spark, str(tree), (".png",), ignore_case=False).count() == 6
    sizes = files.list_assets(spark, str(tree))
    assert "content" not in plan(sizes) and sizes.agg(F.sum("file_size_bytes")).first()[0] == 6 * 7


def test_flatten_splits(spark, tree):
    flat = files.flatten_splits(files.list_labelled(spark, str(tree)))
    names = {(r.true_label, r.flat_name) for r in flat.collect()}
    assert len(names) == 24 and ("NORMAL", "train_name0.png") in names


def test_flatten_keeps_one_of_a_name(spark):
    df = spark.createDataFrame([("/b/train/N/x.png",), ("/a/train/N/x.png",), ("/a/other/N/x.png",)], "file_path string")
    assert rows(files.flatten_splits(df)) == [("N", "train_x.png", "/a/train/N/x.png")]


def requests_for(spark, names):
    return spark.createDataFrame([(f"r{i}", n) for i, n in enumerate(names)], "request_id string, file_path string")


@pytest.mark.parametrize("limit", [0, 1000])
def test_assets_join_across_spellings(spark, tree, limit):
    p = str(tree / "train" / "NORMAL" / "name0.png")
    wanted = requests_for(spark, [p, f"file://{p}", "/nowhere.png", p])
    stored = files.read_assets(spark, str(tree))
    got = assets.join_assets(wanted, stored, max_broadcast_bytes=limit)
    assert [r.request_id for r in got.orderBy("request_id").collect()] == ["r0", "r1", "r3"]
    assert {bytes(r.content) for r in got.collect()} == {b"x"}
    listing = files.list_assets(spark, str(tree))
    for salts in (1, 5):
        assert assets.match_assets(wanted, listing, salts).count() == 3
    assert rows(assets.missing_assets(wanted, listing).select("request_id")) == [("r2",)]


def test_broadcast_side_is_the_requests(spark, tree):
    wanted = requests_for(spark, ["/a.png"])
    text = plan(assets.join_assets(wanted, files.read_assets(spark, str(tree))))
    assert "BroadcastHashJoin" in text and "BuildRight" in text


def test_fetch_reads_in_the_task(spark, tree):
    listing = files.list_assets(spark, str(tree))
    gone = requests_for(spark, ["/gone.png"]).selectExpr("request_id AS image_id", "file_path")
    named = listing.select("image_id", "file_path").unionByName(gone)
    got = assets.fetch_content(named, "file_path", max_chunk_bytes=4)
    assert got.count() == 25
    assert got.agg(F.sum(F.octet_length("content"))).first()[0] == 6 * 7
    assert got.filter("content IS NULL").count() == 1
    assert got.filter("fetch_error = 'not found'").count() == 1


def test_fetch_takes_paths_as_they_are(spark, tmp_path):
    names = ["a b.png", "c%20d.png", "e#f.png", "g?h.png", "é.png"]
    for name in names:
        (tmp_path / name).write_bytes(name.encode())
    listed = files.list_assets(spark, str(tmp_path))
    got = assets.fetch_content(listed, "file_path").collect()
    assert {bytes(r.content).decode() for r in got} == set(names)
    assert {bytes(r.content).decode() for r in got if bytes(r.content).decode() == r.image_id} == set(names)
    missing = spark.createDataFrame([("r", None)], "request_id string, asset_path string")
    row = assets.fetch_content(missing).first()
    assert (row.content, row.fetch_error) == (None, "no path")


def test_an_unreadable_file_fails_the_task(spark, tmp_path):
    folder = spark.createDataFrame([("r", str(tmp_path))], "request_id string, asset_path string")
    with pytest.raises(Exception, match="(?i)directory|not a regular file"):
        assets.fetch_content(folder).collect()


def test_stores_are_opened_once_and_by_their_scheme(monkeypatch):
    from pyarrow import fs

    opened = []

    class Store:
        def open_input_stream(self, inner):
            opened.append(inner)

    seen = []

    class Systems:
        @staticmethod
        def from_uri(uri):
            seen.append(uri)
            return Store(), ""

    monkeypatch.setattr(fs, "FileSystem", Systems)
    systems = {}
    for name in ("s3a://b/x y%20#.png", "s3n://b/k//z", "s3://b/q", "hdfs://nn:8020/a b"):
        assets._open(systems, name)
    assert seen == ["s3://b/", "hdfs://nn:8020/"]
    assert opened == ["b/x y%20#.png", "b/k//z", "b/q", "/a b"]


def test_keys_that_differ_by_a_slash_stay_apart(spark):
    wanted = requests_for(spark, ["s3a://b/a//x.png", "s3://b/a/x.png"])
    listing = spark.createDataFrame([("s3a://b/a/x.png",), ("s3a://b/a//x.png",)], "file_path string")
    got = {r.file_path: r.asset_path for r in assets.match_assets(wanted, listing).collect()}
    assert got == {"s3a://b/a//x.png": "s3a://b/a//x.png", "s3://b/a/x.png": "s3a://b/a/x.png"}
    twice = spark.createDataFrame([("file:/q.png",), ("/q.png",)], "file_path string")
    assert assets.match_assets(requests_for(spark, ["/q.png"]), twice).count() == 1


def test_request_generation(spark):
    data = [(f"/d/{l}/f{i}.png", l) for l in ("B", "A") for i in range(8)]
    listing = spark.createDataFrame(data, "file_path string, true_label string").repartition(5)
    at = F.lit(TS).cast("timestamp")
    got = rows(ingest.number_requests(listing, at=at), "request_id")
    assert [(r[0], r[2]) for r in got[:2]] == [("/d/A/f0.png", "req_00000000"), ("/d/A/f1.png", "req_00000001")]
    assert got[-1][:3] == ("/d/B/f7.png", "B", "req_00000015") and got[0][3] == TS
    assert ingest.number_requests(listing, limit=3).count() == 3
    shown = rows(ingest.preview(ingest.number_requests(listing, at=at)))
    assert len(shown) == 10
    back = decode.decode_requests(ingest.request_messages(ingest.number_requests(listing, at=at)))
    assert back.count() == 16 and back.select("ingest_ts").distinct().first()[0] == MOMENT


def test_dispatch(spark, tree, tmp_path):
    assert load_requests(spark, SourceSpec(tree=str(tree))).count() == 24
    assert load_requests(spark, SourceSpec(object_store=str(tree), tree="/no")).count() == 24
    path = tmp_path / "manifest.json"
    path.write_text('[{"s3_key":"k","s3_uri":"u","local_path":"/p","label":"NORMAL"},\n {"local_path":"/q"}]')
    got = load_requests(spark, SourceSpec(manifest=str(path)))
    assert sorted(rows(got), key=str) == [("/p", "NORMAL"), ("/q", None)]
    lines = tmp_path / "lines.json"
    lines.write_text('\n{"local_path":"/p","label":"A"}\n{"local_path":"/q"}\n{"local_path":"/r"}\n')
    assert load_requests(spark, SourceSpec(manifest=str(lines))).count() == 3
    assert load_requests(spark, SourceSpec(manifest=str(lines), manifest_layout="lines")).count() == 3
    lines.write_text('{"local_path":"/p"}\n{"local_pa')
    with pytest.raises(Exception, match="(?i)malformed"):
        load_requests(spark, SourceSpec(manifest=str(lines))).collect()
    with pytest.raises(ValueError):
        load_requests(spark, SourceSpec(topic="t"))
    with pytest.raises(ValueError):
        load_requests(spark, SourceSpec())


def test_topic_options(monkeypatch):
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def option(self, key, value):
            seen[key] = value
            return self

        def options(self, **extra):
            seen.update(extra)
            return self

        def load(self):
            return "frame"

    class Session:
        read = readStream = Reader()

    assert topics.read_topic(Session(), "h:9092", "t", minPartitions="8") == "frame"
    assert seen["format"] == "kafka" and seen["subscribe"] == "t" and seen["minPartitions"] == "8"
    assert (seen["startingOffsets"], seen["endingOffsets"]) == ("earliest", "latest")
    seen.clear()
    topics.stream_topic(Session(), "h:9092", "t")
    assert "endingOffsets" not in seen


def test_summary_backfill(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("run_label,num_images,wall_time_sec,wall_throughput_img_per_sec\nr,20,100.0,0.2\n")
    got = tables.read_summary(spark, str(path)).first()
    assert (got.success_count, got.error_count, got.mean_latency_ms) == (20, 0, 5000.0)
    assert got.p95_latency_ms == pytest.approx(6000.0)
