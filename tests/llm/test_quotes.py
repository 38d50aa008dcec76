"""Quotation linking on threads written out by hand."""

from pyspark.sql import functions as F

from loadlens.llm.quotes import link_quotations, passages


def link(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string, root long, hash string")
    out = link_quotations(df).select(
        "thread", "at", "text", "n_quotes", "n_linked", "parent", "root", "depth"
    )
    return sorted(map(tuple, out.collect()), key=str)


def row(conv, turn, text):
    return (conv, turn, text, 7, "clash")


def test_nested_quotes(spark):
    rows = [
        row(1, 0, "First question\nsecond  line"),
        row(1, 1, "> first question\n> Second line\n\nAn answer"),
        row(1, 2, ">> First question\n>> second line\n> An answer\nThanks\n> unknown words"),
        row(1, 3, "> second line\nOnly one line was quoted"),
        row(1, 4, "> Thanks\nok"),
        row(2, 0, "> An answer\nin another thread"),
    ]
    assert link(spark, rows) == [
        (1, 0, "First question\nsecond  line", 0, 0, None, 0, 0),
        (1, 1, "An answer", 1, 1, 0, 0, 1),
        (1, 2, "Thanks", 3, 2, 1, 0, 2),
        (1, 3, "Only one line was quoted", 1, 1, 0, 0, 1),
        (1, 4, "ok", 1, 1, 2, 0, 3),
        (2, 0, "in another thread", 1, 0, None, 0, 0),
    ]


def test_ties_nulls_and_repeated_rows(spark):
    rows = [
        row(1, 5, "ok"),
        row(1, 6, "ok"),
        row(1, 7, "> ok\nyes"),
        row(1, 7, "> ok\nyes"),
        row(1, 4, "> ok\nearlier than what it quotes"),
        row(1, 8, None),
        row(1, 9, ""),
        row(1, 10, ">\n> \n"),
        row(None, 1, "> ok"),
        row(3, None, "> ok"),
    ]
    assert link(spark, rows) == sorted(
        [
            (1, 5, "ok", 0, 0, None, 5, 0),
            (1, 6, "ok", 0, 0, None, 6, 0),
            (1, 7, "yes", 1, 1, 5, 5, 1),
            (1, 7, "yes", 1, 1, 5, 5, 1),
            (1, 4, "earlier than what it quotes", 1, 0, None, 4, 0),
            (1, 8, "", 0, 0, None, 8, 0),
            (1, 9, "", 0, 0, None, 9, 0),
            (1, 10, "", 1, 0, None, 10, 0),
            (None, 1, "", 1, 0, None, 1, 0),
            (3, None, "", 1, 0, None, None, 0),
        ],
        key=str,
    )


def test_long_chain_and_one_large_thread(spark):
    rows = [row(1, 0, "m0")] + [row(1, i, f"> m{i - 1}\nm{i}") for i in range(1, 70)]
    rows += [row(1, 100 + i, f"> m0\nreply {i}") for i in range(200)]
    found = link(spark, rows)
    assert {(r[1], r[6], r[7]) for r in found if r[1] < 70} == {(i, 0, i) for i in range(70)}
    assert all(r[5] == 0 and r[7] == 1 for r in found if r[1] >= 100)


def test_long_text_and_empty_table(spark):
    text = "\n".join(("> " * (i % 3)) + f"line {i}" for i in range(20_000))
    df = spark.createDataFrame([(text,)], "text string")
    runs = df.select(F.explode(passages(F.col("text"))).alias("p")).select("p.*").collect()
    assert len(runs) == 20_000 and runs[5].level == 2 and runs[5].text == "line 5"
    assert link(spark, [row(1, 1, "x")])[0][3] == 0
    empty = spark.createDataFrame([], "conv_id long, turn long, text string")
    assert link_quotations(empty).collect() == []
