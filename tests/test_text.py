import pytest
from pyspark.sql import functions as F

from loadlens.functions import text
from loadlens.operators import reports
from loadlens.plans import gallery
from tests.helpers import MOMENT, plan, rows


def cleaned(spark, report):
    df = spark.createDataFrame([(report,)], "report_text string")
    return reports.with_markup(df).first().report_html


@pytest.mark.parametrize("report", [None, "", "Error"])
def test_failed_reports(spark, report):
    assert cleaned(spark, report) == text.FAILED_HTML


@pytest.mark.parametrize("report", ["Okay, ", "Signature: me\n", "  \n \n", "* \n- "])
def test_empty_reports(spark, report):
    assert cleaned(spark, report) == text.EMPTY_HTML


@pytest.mark.parametrize(
    "report,want",
    [
        ("plain", "<p>plain</p>"),
        ("Okay, here is the report: Clear.", "<p>Clear.</p>"),
        ("I have analyzed it.\nHere is the report:\nClear.", "<h3>I have analyzed it.</h3>\n<p>Clear.</p>"),
        ("II. Lungs", "<h3>II. Lungs</h3>"),
        ("VII. Lungs", "<p>VII. Lungs</p>"),
        ("IV Lungs", "<h3>IV Lungs</h3>"),
        ("IIII. Lungs", "<p>IIII. Lungs</p>"),
        ("* **Heart:** normal", '<div class="section-header"><strong>Heart:</strong> normal</div>'),
        ("a **b** c **d**", "<p>a <strong>b</strong> c <strong>d</strong></p>"),
        ("- one\n• two\n*three", "<ul>\n<li>one</li>\n<li>two</li>\n<li>three</li>\n</ul>"),
        ("- one\n\n- two", "<ul>\n<li>one</li>\n</ul>\n<ul>\n<li>two</li>\n</ul>"),
        ("- one\n-\n- two", "<ul>\n<li>one</li>\n<li>two</li>\n</ul>"),
        ("- one\nBased on views\n- two", "<ul>\n<li>one</li>\n<li>two</li>\n</ul>"),
        ("- one\ntext\nI. End", "<ul>\n<li>one</li>\n</ul>\n<p>text</p>\n<h3>I. End</h3>"),
        ("**Patient:** x\n**DATE:** y\nBody\nRadiologist: z\nmore", "<p>Body</p>\n<p>more</p>"),
        (
            "**Radiology Report**\nold\nold **II.** x",
            "<p><strong>II.</strong> x</p>",
        ),
        ("**Radiology Report** a\nb I. Lungs\nclear", "<h3>I. Lungs</h3>\n<p>clear</p>"),
        (" 　 wide blanks  ", "<p>wide blanks</p>"),
        ("one\r\ntwo\u2028three", "<p>one</p>\n<p>two\u2028three</p>"),
    ],
)
def test_cleaning(spark, report, want):
    assert cleaned(spark, report) == want


def test_lines(spark):
    df = spark.createDataFrame([(1, "I. A\n\n- b\nokay, c\nd")], "id int, report_text string")
    got = rows(reports.report_lines(df, keep=["id"]), "line_no")
    assert got == [
        (1, 0, "heading", "I. A"),
        (1, 1, "blank", ""),
        (1, 2, "bullet", "- b"),
        (1, 3, "skip", "okay, c"),
        (1, 4, "paragraph", "d"),
    ]


def test_cleaning_needs_no_shuffle_or_python(spark):
    df = spark.createDataFrame([("x",)], "report_text string")
    shown = plan(reports.with_markup(df))
    assert "Exchange" not in shown and "Python" not in shown and "Pandas" not in shown


@pytest.mark.parametrize(
    "answer,want",
    [
        ("Pneumonia.", ("PNEUMONIA", "HIGH")),
        ("  normal, I think", ("NORMAL", "HIGH")),
        ("ABNORMAL", ("NORMAL", "HIGH")),
        ("NORMAL/PNEUMONIA", ("PNEUMONIA", "HIGH")),
        ("The lungs are NORMAL", ("UNKNOWN", "LOW")),
        (".,", ("UNKNOWN", "LOW")),
        ("", ("ERROR", "N/A")),
        (" \n ", ("ERROR", "N/A")),
        (None, ("ERROR", "N/A")),
    ],
)
def test_answers(spark, answer, want):
    df = spark.createDataFrame([(answer,)], "raw_text string")
    got = reports.classify(df).first()
    assert (got.prediction, got.confidence) == want


def test_small_texts(spark):
    row = spark.range(1).select(
        text.error_text(F.lit("ValueError"), F.lit("bad")).alias("e"),
        text.clip(F.lit("x" * 150)).alias("c"),
    ).first()
    assert row.e == "ValueError: bad" and len(row.c) == 100


def test_gallery(spark):
    data = [
        ("/d/IM-2.png", "* a", MOMENT, 2000.0, "A100-80GB", bytearray(b"abc")),
        ("/d/IM-1.png", None, MOMENT, None, None, None),
        ("/d/IM-3.png", "x", MOMENT, 20000.0, "cpu", bytearray(b"")),
    ]
    schema = (
        "file_path string, report_text string, timestamp timestamp, inference_time_ms double, "
        "gpu_used string, content binary"
    )
    df = spark.createDataFrame(data, schema)
    got = rows(gallery.gallery_rows(df, 2, content="content"), "file_path")
    assert got == [
        (
            "/d/IM-1.png", "IM-1", "CXR-TRAIN-IM-1", "December 10, 2025", 0.0, "fast", 0.0,
            "Unknown", text.FAILED_HTML, None,
        ),
        (
            "/d/IM-2.png", "IM-2", "CXR-TRAIN-IM-2", "December 10, 2025", 2.0, "fast", 0.5,
            "A100", "<ul>\n<li>a</li>\n</ul>", "YWJj",
        ),
    ]
