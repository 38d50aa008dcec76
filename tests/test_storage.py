import pytest

from loadlens import schemas
from loadlens.scratch import checkpointed, scratch_path, scratch_root
from loadlens.sinks import files as sinks
from loadlens.sinks import messages
from loadlens.sources import tables
from tests.helpers import pred_row, preds, rows

TEXTS = ['plain', 'two\nlines', 'a "quoted", part', "  padded  ", "", "back\\slash", 'end"', "tab\té"]


def test_text_survives_csv(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    path = str(tmp_path / "c")
    sinks.write_csv(df, path)
    got = dict(rows(tables.read_csv(spark, path, df.schema)))
    assert [got[i] or "" for i in range(len(TEXTS))] == TEXTS


def test_all_formats(spark, tmp_path):
    pred = preds(spark, [pred_row(i, error="E: x" if i % 4 == 0 else None, run=f"run_{i % 2}") for i in range(20)])
    paths = sinks.write_predictions(pred, str(tmp_path), partition_by=["run_label"])
    want = sorted(rows(pred.na.fill("")), key=str)
    columns = pred.columns
    stored = [
        spark.read.schema(pred.schema).parquet(paths["parquet"]),
        tables.read_csv(spark, paths["csv"], pred.schema),
        spark.read.schema(pred.schema).json(paths["json"]),
    ]
    for df in stored:
        assert sorted(rows(df.select(*columns).na.fill("")), key=str) == want
    assert '"error_message":null' in spark.read.text(paths["json"]).filter("value LIKE '%req_00000001%'").first()[0]
    with pytest.raises(ValueError):
        sinks.write_predictions(pred, str(tmp_path / "x"), ["xml"])


def test_other_partitions_stay(spark, tmp_path):
    path = str(tmp_path / "p")
    sinks.write_parquet(preds(spark, [pred_row(1, run="a"), pred_row(2, run="b")]), path, ["run_label"])
    sinks.write_parquet(preds(spark, [pred_row(3, run="b")]), path, ["run_label"])
    got = rows(spark.read.parquet(path).select("request_id", "run_label"), "run_label")
    assert got == [("req_00000001", "a"), ("req_00000003", "b")]


def test_metrics_go_to_every_target(spark, tmp_path):
    table = spark.createDataFrame([("a", 1.5), ("b", None)], "k string, v double")
    targets = [str(tmp_path / t) for t in ("one", "two")]
    sinks.write_metrics({"m": table}, targets)
    for target in targets:
        assert len(list((tmp_path / target / "m").glob("part-*.csv"))) == 1
        assert rows(tables.read_csv(spark, f"{target}/m", table.schema), "k") == [("a", 1.5), ("b", None)]
    texts = tables.read_csv(spark, f"{targets[0]}/m")
    assert dict(texts.dtypes) == {"k": "string", "v": "string"}


def test_absent_side_table_is_empty(spark, tmp_path):
    got = tables.read_optional_csv(spark, str(tmp_path / "none.csv"), schemas.RUN_SUMMARY)
    assert got.count() == 0 and got.schema == schemas.RUN_SUMMARY


def test_messages(spark):
    df = spark.createDataFrame([("r1", None, 2.5)], "request_id string, label string, v double")
    got = messages.as_messages(df, "request_id").first()
    assert got.key == "r1" and got.value == '{"request_id":"r1","label":null,"v":2.5}'


def test_view(spark):
    sinks.register_view(preds(spark, [pred_row(1)]), "seen")
    assert spark.sql("SELECT count(*) FROM seen").first()[0] == 1


def test_scratch(spark):
    root = scratch_root(spark)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(root.rstrip("/"))
    assert checkpointed(spark.range(5)).count() == 5


def test_second_write_without_others_replaces_the_table(spark, tmp_path):
    df = spark.range(4).selectExpr("id", "id % 2 AS part")
    sinks.write_parquet(df, str(tmp_path / "t"), ["part"])
    sinks.write_parquet(df.filter("part = 1"), str(tmp_path / "t"), ["part"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4
    sinks.write_parquet(df.filter("part = 1"), str(tmp_path / "t"), ["part"], keep_others=False)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


@pytest.mark.parametrize("address", ["spark://host:7077", "local-cluster[2,1,1024]", "yarn"])
def test_a_cluster_without_shared_folder_is_refused(address):
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = address

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        scratch_root(Session())
