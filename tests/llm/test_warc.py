"""WARC archives: a round trip, segments in any order, broken segments, chunked bodies."""

import base64
import gzip
import hashlib

import pytest

from loadlens.llm import warc

ROWS = [
    (1, "http://a/1", "<p>same</p>"),
    (2, "http://a/2", "<p>same</p>"),
    (3, "http://a/3 x", "<p>same</p>"),
    (4, None, None),
    (5, "http://a/5", ""),
    (6, "http://a/6", "WARC/1.1\r\nContent-Length: 5\r\n\r\nnot one\r\n\r\n" * 3),
    (7, "http://a/7", "é💥" * 40_000),
    (8, "http://a/8", "0\r\n\r\n" + "x" * 9000),
    (8, "http://a/8", "0\r\n\r\n" + "x" * 9000),
    (9, "http://a/9", "é💥" * 40_000),
    (None, "http://a/n", "<p>same</p>"),
    (None, "http://a/n", "no id"),
]


def expected(rows):
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        ids = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        first = max(ids, default=None)
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        revisit = i is not None and i != first
        out.append(
            (i, len(raw), digest, "revisit" if revisit else "response", first if revisit else None)
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("segment", [64, warc.SEGMENT])
def test_round_trip(spark, segment):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    found = warc.round_trip(pages, segment=segment)
    assert sorted(map(tuple, found.collect()), key=str) == expected(ROWS)
    assert warc.round_trip(pages.limit(0)).collect() == []


def archive(tmp_path, name, items):
    (tmp_path / name).write_bytes(b"".join(r + b"\r\n\r\n" for r in items))


def test_segments_of_other_files_in_any_order(spark, tmp_path):
    payload = bytes(range(256)) * 20
    parts = warc.records("1", "k", "u", payload, "D", None, 100)
    assert len(parts) > 50
    for k in range(3):
        archive(tmp_path, f"{k}.warc", [*parts[k::3][::-1], *parts[k : k + 1]])  # one twice
    row = warc.read_archives(spark, str(tmp_path)).collect()
    assert [bytes(r.payload) for r in row] == [payload]


def test_broken_segments_have_no_payload(spark, tmp_path):
    parts = [warc.records(str(k), "k", "u", b"abc" * 100, "D", None, 50) for k in range(4)]
    whole, lacking, short, other = parts
    del lacking[2]
    short.pop()
    other[1] = other[1].replace(b"abc", b"ab", 1).replace(b"Content-Length: 50", b"Content-Length: 49")
    archive(tmp_path, "a.warc", [x for p in (whole, lacking, short, other) for x in p])
    found = warc.read_archives(spark, str(tmp_path))
    got = {r.record_id: r.payload and bytes(r.payload) for r in found.collect()}
    want = {f"<urn:loadlens:page:{k}:k>": b"abc" * 100 if k == 0 else None for k in range(4)}
    assert got == want


def test_chunks():
    for size in (1, 7, 100):
        assert warc.unchunked(warc.chunked(b"some payload", size)) == b"some payload"
    assert warc.unchunked(b"4;x=1\r\nabcd\r\n0\r\nTrailer: y\r\n\r\n") == b"abcd"
    for broken in (b"", b"zz\r\n", b"4\r\nabc", b"4\r\nabcd\r\n", b"-1\r\n\r\n"):
        assert warc.unchunked(broken) is None
    assert warc.payload_of(b"HTTP/1.1 200 OK\r\n\r\nplain") == b"plain"


def test_ids_of_any_text(spark):
    ids = ["a:b", "a>c", "a", "", "=", "%3A", "é +&", None]
    pages = spark.createDataFrame([(i, "u", f"<p>{k % 3}</p>") for k, i in enumerate(ids)], "page_id string, url string, html string")
    found = warc.round_trip(pages).collect()
    assert sorted((r.page_id for r in found), key=str) == sorted(ids, key=str)
    best = {k: max(i for n, i in enumerate(ids) if n % 3 == k and i is not None) for k in range(3)}
    want = {i: None if i in (None, best[k % 3]) else best[k % 3] for k, i in enumerate(ids)}
    assert {r.page_id: r.refers_to for r in found} == want


def test_most_pages_are_segmented():
    for size in (4000, 9000, 40_000):
        assert len(warc.records("1", "k", "u", b"x" * size, "D", None, warc.SEGMENT)) > size // 4096


def test_broken_records(spark, tmp_path):
    good = [warc.records(str(k), "k", "u", b"abc" * 2000, "D", None, 4096) for k in range(3)]
    assert all(len(g) == 2 for g in good)
    lost = good[1][0].replace(b"Content-Length", b"Content-Size")
    odd = good[1][1].replace(b"Segment-Number: 2", b"Segment-Number: two")
    archive(tmp_path, "a.warc", [*good[0], lost, odd, *good[2]])
    whole = b"".join(r + b"\r\n\r\n" for r in good[0])
    (tmp_path / "cut.warc").write_bytes(whole.replace(b"page:0", b"page:7")[:-1000])
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(whole.replace(b"page:0", b"page:8")) + gzip.compress(whole)[:-20])
    (tmp_path / "none.warc").write_bytes(b"no records here")
    (tmp_path / "empty.warc").write_bytes(b"")
    found = warc.read_archives(spark, str(tmp_path)).collect()
    got = {r.record_id: r.payload and bytes(r.payload) for r in found}
    want = {f"<urn:loadlens:page:{k}:k>": b"abc" * 2000 for k in (0, 2, 8)}
    assert got == want | {"<urn:loadlens:page:7:k>": None}
    for broken in (b"WARC/1.1\r\nContent-Length: 9", b"WARC/1.1\r\n\r\n", b"WARC/1.1\r\nContent-Length: -4\r\n\r\nx", b"\x1f\x8bxx"):
        assert list(warc.parse(broken)) == []
