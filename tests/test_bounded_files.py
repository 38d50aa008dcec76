"""Written trees and manifests of a large group, the files they are cut into, and what is read back."""

import hashlib
from collections import Counter

from pyspark.sql import functions as F

from loadlens.catalog import registry, storage
from loadlens.operators import partitions
from loadlens.plans import job
from loadlens.sources import files
from tests.compare import differences, duck
from tests.helpers import plan, rows


def pages(spark, tmp_path, n):
    made = [
        (i, f"http://host/{'en' if i % 7 else 'de'}/p{i}", f"<p>é {i}\n\nline {i % 5}</p>") for i in range(n)
    ]
    df = spark.createDataFrame(made, "page_id long, url string, html string").coalesce(1)
    df.write.parquet(str(tmp_path / "pages.parquet"))
    return made


def test_a_large_folder_has_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "FILE_PAGES", 20)
    made = pages(spark, tmp_path, 300)
    tree = storage._page_tree(spark, str(tmp_path))
    found = files.read_assets(spark, tree, (".txt",)).select("content").collect()
    assert max(bytes(r.content).count(b"</p>") for r in found) <= 20
    assert sum(bytes(r.content).count(b"</p>") for r in found) == 300
    lines = {}
    for i, url, html in made:
        key = ("split=" + ["train", "test", "val"][i % 3], "label=" + url.split("/")[3])
        lines.setdefault(key, []).extend(html.encode().split(b"\n"))
    want = sorted((*k, hashlib.md5(b"\n".join(sorted(v))).hexdigest(), None) for k, v in lines.items())
    for query in (storage.score_content, storage.load_test_content):
        assert sorted(rows(query(spark, str(tmp_path)))) == want


def test_a_file_that_fails_is_an_error_of_its_folder(spark):
    pred = spark.createDataFrame(
        [("/a/split=x/label=y/1.txt", "b\nc", None), ("/a/split=x/label=y/2.txt", "", "E: bad")],
        "file_path string, report_text string, error_message string",
    )
    assert rows(storage._scored_files(pred)) == [("split=x", "label=y", None, "E: bad")]
    assert rows(storage._scored_files(pred.limit(1))) == [
        ("split=x", "label=y", hashlib.md5(b"b\nc").hexdigest(), None)
    ]


def test_a_folder_has_the_digest_of_all_its_lines_in_order(spark, monkeypatch):
    monkeypatch.setattr(storage, "BLOCK_BYTES", 20)
    lines = {
        "many": [f"line {i % 70}" for i in range(300)],
        "one": ["same"] * 50,
        "bare": ["", "", "é", "\u4e00" * 30, "Z", "a"],
        "empty": [""],
    }
    # Two files a folder, the lines of both mixed in the order.
    scored = [
        (f"/a/split=x/label={k}/{i}.txt", "\n".join(v[i::2]), None)
        for k, v in lines.items()
        for i in (0, 1)
        if v[i::2]
    ]
    pred = spark.createDataFrame(scored, "file_path string, report_text string, error_message string")
    found = storage._scored_files(pred)
    assert found.columns == ["split", "label", "digest", "error_message"]
    want = [
        ("split=x", f"label={k}", hashlib.md5(b"\n".join(sorted(t.encode() for t in v))).hexdigest(), None)
        for k, v in lines.items()
    ]
    assert sorted(rows(found)) == sorted(want)


def test_folders_are_cut_by_few_and_short_starts_of_lines(spark, monkeypatch):
    monkeypatch.setattr(storage, "BLOCK_BYTES", 50)
    monkeypatch.setattr(storage, "PIECE_BYTES", 500)
    monkeypatch.setattr(storage, "CUT_CHARS", 12)
    lines = {
        "alike": [f"<!DOCTYPE html> {i * 37 % 400:03d} é" for i in range(400)],  # one start for all
        "often": ["same"] * 500 + ["\U0001f600", "\uffff", ""],
        "few": ["b", "a"],
    }
    scored = [
        (f"/a/split=x/label={k}/{i}.txt", "\n".join(v[i::3]), None)
        for k, v in lines.items()
        for i in range(3)
        if v[i::3]
    ]
    pred = spark.createDataFrame(scored, "file_path string, report_text string, error_message string")
    found = storage._scored_files(pred)
    want = [
        ("split=x", f"label={k}", hashlib.md5(b"\n".join(sorted(t.encode() for t in v))).hexdigest(), None)
        for k, v in lines.items()
    ]
    assert sorted(rows(found)) == sorted(want)
    # A sort by range would send 300 whole lines for each of its partitions to the driver.
    assert "rangepartitioning" not in plan(found)

    flat = [("split=x", f"label={k}", t, None, i) for k, v in lines.items() for i, t in enumerate(v)]
    flat = spark.createDataFrame(flat, "split string, label string, line string, error_message string, place long")
    total = sum(len(r.line.encode()) + 1 for r in flat.collect())
    dealt = storage._with_pieces(flat, total).collect()
    assert len(dealt) == sum(map(len, lines.values()))
    assert len({r.piece for r in dealt if r.label == "label=often"}) > 1
    for label in {r.label for r in dealt}:
        keys = sorted((r.line.encode(), r.place, r.piece) for r in dealt if r.label == label)
        assert [k[2] for k in keys] == sorted(k[2] for k in keys)
    monkeypatch.setattr(storage, "MOST_CUTS", 3)
    assert len({(r.label, r.piece) for r in storage._with_pieces(flat, total).collect()}) < 20


def test_scored_folders_of_odd_pages_agree_with_the_sql(spark, tmp_path):
    urls = ["en/p", "a b/p", "a+b/p", "a%20b/p", "a=b:c/p", "é#?/p", "/p", ""]
    made = [(i - 12, f"http://host/{urls[i % 8]}", f"{i}\n\nä\r\n") for i in range(24)]
    made += [(20, None, "no url"), (21, "http://host", "short"), (None, "http://host/en/p", "no id")]
    made += [(30, "http://host/en/p", None), (31, "http://host/bare/p", None), (32, "http://host/en/p", "")]
    pages = spark.createDataFrame(made, "page_id long, url string, html string").coalesce(1)
    pages.toPandas().astype({"page_id": "Int64"}).to_parquet(tmp_path / "pages.parquet")
    for name in ("score_content", "load_test_content"):
        found = registry.QUERIES[name](spark, str(tmp_path))
        assert differences(found, duck(str(tmp_path)), registry.ORACLES[name], 30) == []


def test_manifest_arrays_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "ARRAY_ENTRIES", 30)
    made = pages(spark, tmp_path, 200)
    written = {}
    real = storage.scratch_path
    monkeypatch.setattr(storage, "scratch_path", lambda s, name: written.setdefault(name, real(s, name)))
    found = rows(storage.manifest_array(spark, str(tmp_path)).select("file_path"))
    assert Counter(r[0] for r in found) == Counter(url for _, url, _ in made)
    arrays = spark.read.text(written["manifest"]).selectExpr("size(from_json(value, 'array<string>'))")
    assert max(r[0] for r in arrays.collect()) <= 30


def test_content_is_read_by_tasks_of_bounded_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "FILE_PAGES", 20)
    pages(spark, tmp_path, 300)
    requests, listing, _ = storage._content_requests(spark, str(tmp_path))
    total = listing.agg({"file_size_bytes": "sum"}).first()[0]
    monkeypatch.setattr(partitions, "BYTES_PER_TASK", total // 8)
    found = job.with_content(requests, listing, slots=2).select("content", F.spark_partition_id().alias("task"))
    held = Counter()
    for r in found.collect():
        held[r.task] += len(r.content)
    assert sum(held.values()) == total and len(held) > 4
    assert partitions.waves(10, 4, total_bytes=0) == 4
    assert partitions.waves(1000, 4, total_bytes=9 * 4 * partitions.BYTES_PER_TASK) == 36
