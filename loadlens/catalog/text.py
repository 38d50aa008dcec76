"""Label parsing, report lines and cleaned reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.catalog.registry import query
from loadlens.catalog.views import P, predictions, table
from loadlens.functions import paths, text
from loadlens.operators import labels, metrics, reports
from loadlens.plans import gallery

# Answers of a classifier made from whole turns: an assistant's first word is replaced by a class
# word, other turns keep theirs, and every third turn stays without an answer. Letters outside a-z
# leave, as engines upper-case them differently.
_ANSWERS_SQL = r"""A AS (SELECT concat(conv_id, '-', turn) AS image_id,
  CASE WHEN turn % 3 = 2 THEN ' ' WHEN role = 'assistant' THEN concat('Pneumonia., ', t) WHEN role = 'system' THEN concat('  abnormal ', t)
  ELSE t END AS raw_text
  FROM (SELECT *, regexp_replace(text, '[^A-Za-z\s.,]', '', 'g') AS t FROM conversations))"""
_PARSED_SQL = rf"""{_ANSWERS_SQL},
W AS (SELECT *, regexp_replace(upper(regexp_extract(raw_text, '^[\s\pZ]*([^\s\pZ]+)', 1)),
  '^[.,]+|[.,]+$', '', 'g') AS w, regexp_matches(raw_text, '[^\s\pZ]') AS has_word FROM A),
C AS (SELECT image_id, CASE WHEN NOT has_word THEN 'ERROR' WHEN contains(w, 'PNEUMONIA') THEN 'PNEUMONIA'
  WHEN contains(w, 'NORMAL') THEN 'NORMAL' ELSE 'UNKNOWN' END AS prediction FROM W)"""


def _answers(spark, sf_dir) -> DataFrame:
    t = F.regexp_replace("text", r"[^A-Za-z\s.,]", "")
    return table(spark, sf_dir, "conversations").select(
        F.concat("conv_id", F.lit("-"), "turn").alias("image_id"),
        F.when(F.col("turn") % 3 == 2, F.lit(" "))
        .when(F.col("role") == "assistant", F.concat(F.lit("Pneumonia., "), t))
        .when(F.col("role") == "system", F.concat(F.lit("  abnormal "), t))
        .otherwise(t)
        .alias("raw_text"),
    )


@query(
    "parse_label",
    f"""WITH {_PARSED_SQL} SELECT image_id, prediction, CASE prediction WHEN 'ERROR' THEN 'N/A'
  WHEN 'UNKNOWN' THEN 'LOW' ELSE 'HIGH' END AS confidence FROM C""",
)
def parse_label(spark, sf_dir) -> DataFrame:
    return reports.classify(_answers(spark, sf_dir)).drop("raw_text")


@query(
    "prediction_counts",
    f"WITH {_PARSED_SQL} SELECT prediction, count(*) AS count FROM C GROUP BY prediction",
)
def prediction_counts(spark, sf_dir) -> DataFrame:
    return metrics.counts_desc(reports.classify(_answers(spark, sf_dir)), "prediction")


@query(
    "error_count",
    f"""WITH {_PARSED_SQL} SELECT count(*) AS total,
  count(*) FILTER (WHERE prediction = 'ERROR') AS total_errors FROM C""",
)
def error_count(spark, sf_dir) -> DataFrame:
    return labels.class_report(reports.classify(_answers(spark, sf_dir)))


@query(
    "error_samples",
    f"""WITH {_PARSED_SQL} SELECT image_id, raw_text FROM C JOIN A USING (image_id)
WHERE prediction = 'ERROR' ORDER BY image_id LIMIT 5""",
)
def error_samples(spark, sf_dir) -> DataFrame:
    found = labels.error_samples(reports.classify(_answers(spark, sf_dir)))
    return found.select("image_id", "raw_text")


# Reports made from whole documents: frequent words become bold marks, headings, sub-headings and
# bullets, between the boilerplate the cleaning removes.
_HEAD = (
    "Okay, I will analyze the image and give a full report:\\n"
    "**Radiology Report**\\n**Patient:** unknown\\nRadiologist: unknown\\n"
    "I. FINDINGS\\n"
)
_TAIL = "\\n* \\n\\n**Signature:** unknown\\nSignature: none\\n- done"
_STEPS = (
    (". ", ".\\n* "),
    (" the ", " **the** "),
    (" de ", "\\n\\nII. "),
    (" le ", "\\n* **Le:** "),
    (" and ", "\\nHere is "),
    (" der ", "\\n\\n"),
)


def _made_report(newline: str) -> str:
    """Expression over ``text``; the engines write a line break differently."""

    def lit(s: str) -> str:
        return "'" + s.replace("\\n", f"' || {newline} || '") + "'"

    out = "text"
    for old, new in _STEPS:
        out = f"replace({out}, {lit(old)}, {lit(new)})"
    return f"({lit(_HEAD)} || {out} || {lit(_TAIL)})"


def _reports(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id", f"{_made_report('char(10)')} AS report_text"
    )


def _replace_all(value: str, pattern: str, by: str) -> str:
    return f"regexp_replace({value}, '{pattern}', '{by}', 'g')"


def _stripped_sql(value: str) -> str:
    """Cleaning steps in the oracle's regular expressions; a look-ahead becomes a kept group."""
    value = _replace_all(
        value,
        r"(?im)^(Okay,?\s*)?(I\s+will\s+analyze|I\s+have\s+analyzed|Here\s+is|Let\s+me\s+provide"
        r"|Based\s+on).*?report[:\.]?\s*",
        "",
    )
    value = _replace_all(value, r"(?i)^\s*Okay[,\.]?\s*", "")
    value = _replace_all(
        value, r"(?s)\*\*Radiology Report\*\*.*?(\*\*I\.|I\.|\*\*II\.|II\.)", r"\1"
    )
    for head in ("Patient", "Date", "Study Type", "Quality", "Radiologist"):
        value = _replace_all(value, rf"(?i)\*\*{head}:\*\*.*?\n", "")
    value = _replace_all(value, r"(?i)Radiologist:.*?\n", "")
    value = _replace_all(value, r"(?i)\*\*Signature:\*\*.*?\n", "")
    value = _replace_all(value, r"(?i)Signature:.*?\n", "")
    return _replace_all(value, r"\*\*(.*?)\*\*", r"<strong>\1</strong>")


_STRIP = r"regexp_replace({}, '^[\s\pZ]+|[\s\pZ]+$', '', 'g')"
_LINES_SQL = rf"""S AS (SELECT doc_id, string_split({_stripped_sql(_made_report('chr(10)'))}, chr(10)) AS parts
  FROM documents),
X AS (SELECT doc_id, unnest(parts) AS raw, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS line_no
  FROM S),
Y AS (SELECT doc_id, line_no, {_STRIP.format("raw")} AS line FROM X),
Z AS (SELECT *, regexp_replace(line, '^[*\-•]\s*', '') AS item FROM Y),
K AS (SELECT doc_id, line_no, line, item, CASE WHEN line = '' THEN 'blank'
  WHEN contains(lower(line), 'radiologist:') OR contains(lower(line), 'signature:')
    OR contains(lower(line), 'okay,') OR contains(lower(line), 'i will analyze')
    OR contains(lower(line), 'here is') OR contains(lower(line), 'based on') THEN 'skip'
  WHEN regexp_matches(line, '^(I{{1,3}}|IV|V|VI)\.?\s+') THEN 'heading'
  WHEN regexp_matches(line, '^\*?\s*<strong>[^:]+:</strong>') THEN 'subheading'
  WHEN regexp_matches(line, '^[*\-•]') THEN CASE WHEN item = '' THEN 'skip' ELSE 'bullet' END
  ELSE 'paragraph' END AS kind FROM Z)"""


@query("report_lines", f"WITH {_LINES_SQL} SELECT doc_id, line_no, kind, line FROM K")
def report_lines(spark, sf_dir) -> DataFrame:
    return reports.report_lines(_reports(spark, sf_dir), keep=["doc_id"])


@query(
    "clean_report",
    rf"""WITH {_LINES_SQL},
N AS (SELECT doc_id, line_no, kind, line, item FROM K WHERE kind <> 'skip'
  UNION ALL SELECT doc_id, 2147483647, 'blank', '', '' FROM S),
B AS (SELECT *, coalesce(lag(kind) OVER (PARTITION BY doc_id ORDER BY line_no), 'blank') AS before
  FROM N),
O AS (SELECT doc_id, line_no, concat_ws(chr(10),
    CASE WHEN before = 'bullet' AND kind <> 'bullet' THEN '</ul>' END,
    CASE WHEN before <> 'bullet' AND kind = 'bullet' THEN '<ul>' END,
    CASE kind WHEN 'heading' THEN concat('<h3>', line, '</h3>')
      WHEN 'subheading' THEN
        concat('<div class="section-header">', regexp_replace(line, '^\*\s*', ''), '</div>')
      WHEN 'bullet' THEN concat('<li>', item, '</li>')
      WHEN 'paragraph' THEN concat('<p>', line, '</p>') END) AS piece FROM B)
SELECT doc_id, {_STRIP.format("string_agg(piece, chr(10) ORDER BY line_no)")} AS report_html
FROM O WHERE piece <> '' GROUP BY doc_id""",
)
def clean_report(spark, sf_dir) -> DataFrame:
    return reports.with_markup(_reports(spark, sf_dir)).drop("report_text")


@query(
    "gallery_rows",
    f"""WITH {P} SELECT file_path, strftime(make_timestamp(done_us), '%B %d, %Y') AS report_date,
  round(inference_time_ms / 1000, 2) AS latency_sec, 'fast' AS latency_class,
  round(CASE WHEN inference_time_ms > 0 THEN 1000 / inference_time_ms ELSE 0 END, 2)
    AS throughput_per_sec, 'gpu' AS device, concat('<p>', report_text, '</p>') AS report_html
FROM P ORDER BY file_path, request_id LIMIT 10""",
)
def gallery_rows(spark, sf_dir) -> DataFrame:
    """Study ids are left out: for these names they are checksums, which the SQL side lacks."""
    rows = gallery.gallery_rows(predictions(spark, sf_dir), 10, ["file_path", "request_id"])
    return rows.drop("study_id", "case_id")


@query(
    "gallery_all_rows",
    r"""SELECT concat('/scans/IM-', lpad(CAST(doc_id AS VARCHAR), 4, '0'), '.png') AS file_path,
  concat('IM-', lpad(CAST(doc_id AS VARCHAR), 4, '0')) AS study_id,
  concat('CXR-TRAIN-IM-', lpad(CAST(doc_id AS VARCHAR), 4, '0')) AS case_id,
  'January 01, 2024' AS report_date, round(n_chars / 100.0, 2) AS latency_sec,
  CASE WHEN n_chars < 500 THEN 'fast' WHEN n_chars < 1500 THEN 'medium' ELSE 'slow' END AS latency_class,
  round(100.0 / n_chars, 2) AS throughput_per_sec,
  CASE WHEN doc_id % 7 = 0 THEN 'Unknown' ELSE source END AS device,
  to_base64(encode(text)) AS image_base64
FROM documents""",
)
def gallery_all_rows(spark, sf_dir) -> DataFrame:
    scored = table(spark, sf_dir, "documents").selectExpr(
        "concat('/scans/IM-', lpad(CAST(doc_id AS STRING), 4, '0'), '.png') AS file_path",
        "text AS report_text",
        "TIMESTAMP'2024-01-01 12:00:00' AS timestamp",
        "CAST(n_chars * 10 AS DOUBLE) AS inference_time_ms",
        "CASE WHEN doc_id % 7 <> 0 THEN concat(source, '-80GB') END AS gpu_used",
        "CAST(text AS BINARY) AS content",
    )
    rows = gallery.gallery_rows(scored, None, content="content")
    return rows.drop("report_html")


# CRC-32 of a text, bit by bit: the SQL side has no function for it.
_CRC = """xor(list_reduce([CAST(CAST('0x' || substr(hex(stem), 2 * i + 1, 2) AS INTEGER) AS BIGINT)
  FOR i IN range(strlen(stem))], lambda c, b: list_reduce(range(8), lambda x, k:
  xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END), xor(c, b)), 4294967295), 4294967295)"""


@query(
    "study_id_made",
    f"""WITH S AS (SELECT page_id, regexp_replace(split_part(url, '/', -1), '^(.+)\\.[^.]+$', '\\1') AS stem
  FROM pages)
SELECT page_id, concat('STUDY-', lpad(CAST(({_CRC}) % 100000 AS VARCHAR), 5, '0')) AS study_id
FROM S WHERE stem <> '' """,
)
def study_id_made(spark, sf_dir) -> DataFrame:
    """Ids made from the file stem where it holds no number of its own."""
    pages = table(spark, sf_dir, "pages").filter(paths.file_stem("url") != "")
    return pages.select("page_id", paths.study_id("url").alias("study_id"))


@query("clipped_texts", "SELECT doc_id, substr(text, 1, 100) AS shown FROM documents")
def clipped_texts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.clip("text").alias("shown"))
