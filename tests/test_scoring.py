from datetime import datetime
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from loadlens import schemas
from loadlens.operators import metrics
from loadlens.operators.partitions import spread_by_bytes
from loadlens.operators.scoring import Scorer, score
from loadlens.plans.job import LoadTest, run_load_test
from loadlens.sinks import snapshots
from loadlens.sources import tables
from tests.helpers import rows


def shout(model, part: pd.DataFrame):
    if "bad" in part["word"].tolist():
        raise ValueError("bad word")
    return [f"{model}{w}" for w in part["word"]]


def broken_init():
    raise OSError("no weights")


def table(spark, words, tasks=1):
    data = [(f"r{i:03d}", f"/f{i}", datetime(2025, 1, 1), w) for i, w in enumerate(words)]
    schema = "request_id string, file_path string, ingest_ts timestamp, word string"
    return spark.createDataFrame(data, schema).coalesce(tasks)


def test_success(spark):
    out = score(table(spark, ["a", "b", "c"]), Scorer(shout, lambda: "!", 2, "gpu-7"), ["word"])
    assert out.schema.names == schemas.PREDICTION.names
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in schemas.PREDICTION.fields]
    got = out.orderBy("request_id").collect()
    assert [r.report_text for r in got] == ["!a", "!b", "!c"]
    assert {r.gpu_used for r in got} == {"gpu-7"} and {r.batch_size for r in got} == {3}
    assert all(r.error_message is None and r.true_label is None for r in got)
    assert {r.ingest_ts for r in got} == {datetime(2025, 1, 1)}
    for r in got:
        assert r.end_to_end_ms == r.queue_wait_ms + r.inference_time_ms
        assert r.dequeue_ts <= r.timestamp
        wait = (r.dequeue_ts - r.ingest_ts).total_seconds() * 1000
        assert r.queue_wait_ms == pytest.approx(wait, abs=0.01)


def test_a_failed_micro_batch_leaves_the_others(spark):
    words = ["a", "b", "bad", "c", "d"]
    got = rows(score(table(spark, words), Scorer(shout, lambda: "", 2), ["word"]), "request_id")
    assert [r[6] for r in got] == ["a", "b", "", "", "d"]
    assert [r[12] for r in got] == [None, None, *["ValueError: bad word"] * 2, None]
    assert got[0][7] == got[1][7] and got[2][7] == got[3][7]


def test_init_failure_marks_every_row(spark):
    out = score(table(spark, ["a"] * 7, 3), Scorer(shout, broken_init), ["word"])
    got = out.collect()
    assert len(got) == 7
    assert {r.error_message for r in got} == {"Model load failed: no weights"}
    assert {(r.queue_wait_ms, r.inference_time_ms, r.end_to_end_ms) for r in got} == {(0.0, 0.0, 0.0)}
    assert rows(metrics.latency_stats(out)) == [(None,) * 6]


def test_wrong_number_of_results_is_an_error(spark):
    out = score(table(spark, ["a", "b"]), Scorer(lambda m, p: ["x"], None, 2), ["word"])
    assert {r.error_message for r in out.collect()} == {"ValueError: 1 results for 2 rows"}


def test_no_result_is_an_error(spark):
    out = score(table(spark, ["a"]), Scorer(lambda m, p: [None]), ["word"])
    assert out.first().error_message == "ValueError: no result"


def test_only_inputs_reach_the_scorer(spark):
    def columns(model, part):
        return [",".join(part.columns)] * len(part)

    df = table(spark, ["a"]).withColumn("wide", F.lit("x" * 1000))
    out = score(df, Scorer(columns), ["word"], ["wide"]).first()
    assert out.report_text == "request_id,file_path,true_label,word" and len(out.wide) == 1000


def test_time_is_shared_in_a_micro_batch(spark):
    class Clock:
        now = 1_000_000.0

        def __call__(self):
            Clock.now += 1.0
            return Clock.now

    out = score(table(spark, ["a"] * 4), Scorer(shout, lambda: "", 2, clock=Clock()), ["word"])
    assert {r.inference_time_ms for r in out.collect()} == {500.0}
    assert len({r.dequeue_ts for r in out.collect()}) == 1


def test_any_rows_out_as_in(spark):
    words = ["bad" if i % 5 == 0 else "w" for i in range(503)]
    out = score(table(spark, words, 4), Scorer(shout, lambda: "", 3), ["word"], ["word"])
    assert out.count() == 503 and out.select("request_id").distinct().count() == 503
    assert out.filter("word = 'bad'").filter("error_message IS NULL").count() == 0


def test_carried_columns_keep_their_values(spark):
    big = 2**60 + 1
    df = spark.sql(f"SELECT '/a' AS file_path, CAST({big} AS BIGINT) AS n, CAST(1.10 AS DECIMAL(9,2)) AS d, array(1, NULL) AS xs UNION ALL SELECT '/b', NULL, NULL, NULL")
    out = score(df, Scorer(lambda m, p: ["t"] * len(p), None, 2), carry=["n", "d", "xs"])
    got = rows(out.select("file_path", "n", "d", "xs", "true_label"), "file_path")
    assert got[0][1] == big and str(got[0][2]) == "1.10" and got[0][3] == [1, None]
    assert got[1][1:] == (None, None, None, None)


def test_missing_inputs_are_told_before_the_job(spark):
    with pytest.raises(ValueError, match="nothing"):
        score(table(spark, ["a"]), Scorer(shout), ["nothing"])


def test_paths_alone_are_enough(spark):
    df = spark.createDataFrame([("/a",)], "file_path string")
    got = score(df, Scorer(lambda m, p: p["file_path"].tolist())).first()
    assert (got.request_id, got.report_text, got.queue_wait_ms) == (None, "/a", None)


def test_load_test(spark, tmp_path):
    words = ["bad" if i == 3 else "w" for i in range(30)]
    test = LoadTest(str(tmp_path / "out"), [10, 25, 99], inputs=["word"], mirrors=[str(tmp_path / "copy")])
    made = run_load_test(table(spark, words, 3), Scorer(shout, lambda: "", 1), test)
    counts = rows(made["predictions"].groupBy("run_label").count(), "run_label")
    assert counts == [("run_001_10reqs", 10), ("run_002_25reqs", 25)]
    errors = rows(made["error_statistics"].filter("status = 'Error'"), "run_label")
    assert [(r[0], r[2], r[3]) for r in errors] == [("run_001_10reqs", 1, 10.0), ("run_002_25reqs", 1, 4.0)]
    assert made["burst_drain"].count() == 6
    back = tables.read_csv(spark, str(tmp_path / "copy" / "load_test_summary"), made["load_test_summary"].schema)
    assert rows(back.select("run_label", "num_requests", "success_count"), "run_label") == [
        ("run_001_10reqs", 10, 9),
        ("run_002_25reqs", 25, 24),
    ]
    for name in ("parquet", "csv", "json"):
        version = Path(snapshots.current(spark, str(tmp_path / "out")))
        assert (version / ("predictions" if name == "parquet" else f"predictions_{name}")).is_dir()
    again = LoadTest(str(tmp_path / "out"), [5], inputs=["word"], formats=[])
    made = run_load_test(table(spark, words, 3), Scorer(shout, lambda: "", 1), again)
    assert [r.run_label for r in made["load_test_summary"].collect()] == ["run_001_5reqs"]
    assert snapshots.read_published(spark, str(tmp_path / "out"), "predictions").count() == 5
    with pytest.raises(ValueError, match="none of the sizes"):
        run_load_test(table(spark, words), Scorer(shout), LoadTest(str(tmp_path / "no"), [100]))
    everything = run_load_test(
        table(spark, words), Scorer(shout, lambda: "", 1), LoadTest(str(tmp_path / "all"), inputs=["word"])
    )
    assert everything["predictions"].select(F.count_distinct("run_label")).first()[0] == 1


class Calls:
    """Fails on every call whose rows hold a bad word, and counts the calls."""

    def __init__(self, path):
        self.path = path

    def __call__(self, model, part):
        with open(self.path, "a") as f:
            f.write(f"{len(part)}\n")
        if any(w.startswith("bad") for w in part["word"]):
            raise ValueError("cannot read")
        return part["word"].tolist()


@pytest.mark.parametrize("bad", [[], [0], [15], [5, 6], [0, 7, 8, 15], range(16)])
def test_halving_finds_the_rows_that_fail(spark, tmp_path, bad):
    words = [f"{'bad' if i in bad else 'w'}{i}" for i in range(16)]
    calls = tmp_path / "calls"
    scorer = Scorer(Calls(str(calls)), None, 16, halve=True)
    found = score(table(spark, words, 1), scorer, ["word"], ["word"]).collect()
    assert {r.word for r in found if r.error_message} == {w for w in words if w.startswith("bad")}
    assert all(r.report_text == ("" if r.error_message else r.word) for r in found)
    assert {r.error_message for r in found} <= {None, "ValueError: cannot read"}
    assert len(calls.read_text().split()) <= 1 + 2 * 4 * len(bad)


def test_tasks_of_equal_bytes(spark):
    sizes = [1] * 5000 + [10**9] + [1000] * 300 + [None, 0]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "i long, s long").repartition(3)
    found = spread_by_bytes(df, "s", 10).select("i", "s", F.spark_partition_id().alias("t")).collect()
    assert sorted(r.i for r in found) == list(range(len(sizes)))
    even = [10 + i % 7 for i in range(4000)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(even)], "i long, s long").repartition(3)
    found = spread_by_bytes(df, "s", 10).groupBy(F.spark_partition_id()).agg(F.sum("s")).collect()
    assert len(found) == 10 and max(r[1] for r in found) <= sum(even) / 10 + 16
    assert spread_by_bytes(df.limit(0), "s", 4).count() == 0


def test_a_broken_test_leaves_the_one_before(spark, tmp_path):
    root = str(tmp_path / "out")
    words = [f"w{i}" for i in range(12)]
    settings = dict(inputs=["word"], formats=[])
    run_load_test(table(spark, words, 2), Scorer(shout, lambda: "", 1), LoadTest(root, [4, 8], **settings))
    first = snapshots.current(spark, root)
    with pytest.raises(Exception, match="no clock"):  # the second run never ends
        run_load_test(table(spark, words, 2), Scorer(shout, lambda: "", 1, clock=no_clock), LoadTest(root, [12], **settings))
    assert snapshots.current(spark, root) == first
    found = snapshots.read_published(spark, root, "predictions")
    assert rows(found.groupBy("run_label").count(), "run_label") == [("run_001_4reqs", 4), ("run_002_8reqs", 8)]
    for _ in range(3):
        snapshots.publish_tables(root, {"a": spark.range(3), "b": spark.range(4)})
    assert snapshots.read_published(spark, root, "b").count() == 4
    assert len(list((tmp_path / "out" / "versions").iterdir())) == 2
    assert snapshots.current(spark, str(tmp_path / "none")) is None
    with pytest.raises(FileNotFoundError):
        snapshots.read_published(spark, str(tmp_path / "none"), "a")


def no_clock():
    raise RuntimeError("no clock")
