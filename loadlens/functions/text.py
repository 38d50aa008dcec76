"""Free-text results: label parsing, report cleaning and line classes.

Report cleaning works on the array of lines of one row, so it needs neither a shuffle nor Python.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the report rules. Inline flags: i ignore case, d only \n ends a line,
# m line anchors, s dot matches \n.
PREAMBLE = (
    r"(?idm)^(Okay,?\s*)?"
    r"(I\s+will\s+analyze|I\s+have\s+analyzed|Here\s+is|Let\s+me\s+provide|Based\s+on)"
    r".*?report[:\.]?\s*"
)
OKAY = r"(?id)^\s*Okay[,\.]?\s*"
REPEATED_TITLE = r"(?ds)\*\*Radiology Report\*\*.*?(?=\*\*I\.|I\.|\*\*II\.|II\.)"
METADATA_LINES = (
    r"\*\*Patient:\*\*",
    r"\*\*Date:\*\*",
    r"\*\*Study Type:\*\*",
    r"\*\*Quality:\*\*",
    r"\*\*Radiologist:\*\*",
    r"Radiologist:",
    r"\*\*Signature:\*\*",
    r"Signature:",
)
BOLD = r"(?d)\*\*(.*?)\*\*"
SKIP_WORDS = ("radiologist:", "signature:", "okay,", "i will analyze", "here is", "based on")
SECTION_LINE = r"^(I{1,3}|IV|V|VI)\.?\s+"
SUBHEAD_LINE = r"^\*?\s*<strong>[^:]+:</strong>"
BULLET_MARKS = ("*", "-", "•")
BULLET_MARK = r"^[\*\-•]\s*"
FAILED_HTML = (
    "<p><strong>Report generation failed.</strong> Please review image manually.</p>"
)
EMPTY_HTML = "<p>No report content available.</p>"

# What counts as blank around a line or word.
_BLANK_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(
    chr(c) for c in [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
_BLANKS = f"[{_BLANK_CHARS}]+"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(_BLANK_CHARS))


def error_text(kind: Column | str, message: Column | str) -> Column:
    return F.concat(_c(kind), F.lit(": "), _c(message))


def clip(text: Column | str, n: int = 100) -> Column:
    """The first ``n`` characters, for error messages shown in tables."""
    return F.substring(_c(text), 1, n)


def first_token(text: Column | str) -> Column:
    """First word, upper case, without dots and commas around it; NULL if there is none."""
    word = F.get(F.split(strip(_c(text)), _BLANKS), F.lit(0))
    return F.when(word != "", F.regexp_replace(F.upper(word), r"^[.,]+|[.,]+$", ""))


def label_of(token: Column | str) -> Column:
    """Struct (prediction, confidence) for the first word of a classifier's answer.

    The longer class name is looked for first; a word that merely contains a class name counts.
    No word at all is an error of the scorer.
    """
    t = _c(token)

    def pair(prediction: str, confidence: str) -> Column:
        return F.struct(F.lit(prediction).alias("prediction"), F.lit(confidence).alias("confidence"))

    return (
        F.when(t.isNull(), pair("ERROR", "N/A"))
        .when(t.contains("PNEUMONIA"), pair("PNEUMONIA", "HIGH"))
        .when(t.contains("NORMAL"), pair("NORMAL", "HIGH"))
        .otherwise(pair("UNKNOWN", "LOW"))
    )


def strip_boilerplate(text: Column | str) -> Column:
    """Drop preamble, repeated title block and metadata lines, and turn ``**x**`` into bold tags."""
    t = F.regexp_replace(_c(text), PREAMBLE, "")
    t = F.regexp_replace(t, OKAY, "")
    t = F.regexp_replace(t, REPEATED_TITLE, "")
    for head in METADATA_LINES:
        t = F.regexp_replace(t, f"(?id){head}.*?\\n", "")
    return F.regexp_replace(t, BOLD, "<strong>$1</strong>")


def line_kind(line: Column, lowered: Column) -> Column:
    """Class of one stripped line: blank, skip, heading, subheading, bullet, paragraph."""
    unwanted = reduce(lambda a, b: a | b, [lowered.contains(word) for word in SKIP_WORDS])
    bullet = F.when(bullet_text(line) == "", "skip").otherwise("bullet")
    return (
        F.when(line == "", "blank")
        .when(unwanted, "skip")
        .when(line.rlike(SECTION_LINE), "heading")
        .when(line.rlike(SUBHEAD_LINE), "subheading")
        .when(F.left(line, F.lit(1)).isin(*BULLET_MARKS), bullet)
        .otherwise("paragraph")
    )


def bullet_text(line: Column) -> Column:
    return F.regexp_replace(line, BULLET_MARK, "")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, wherever ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def classified_lines(text: Column | str) -> Column:
    """Array of structs (kind, line), one per line of the cleaned text."""

    def classified(line: Column) -> Column:
        kind = _once(F.lower(line), lambda lowered: line_kind(line, lowered))
        return F.struct(kind.alias("kind"), line.alias("line"))

    lines = F.split(strip_boilerplate(text), "\n")
    return F.transform(lines, lambda raw: _once(strip(raw), classified))


def _tagged(kind: Column, line: Column) -> Column:
    return (
        F.when(kind == "heading", F.concat(F.lit("<h3>"), line, F.lit("</h3>")))
        .when(
            kind == "subheading",
            F.concat(
                F.lit('<div class="section-header">'),
                F.regexp_replace(line, r"^\*\s*", ""),
                F.lit("</div>"),
            ),
        )
        .when(kind == "bullet", F.concat(F.lit("<li>"), bullet_text(line), F.lit("</li>")))
        .when(kind == "paragraph", F.concat(F.lit("<p>"), line, F.lit("</p>")))
    )


def without_skipped(lines: Column) -> Column:
    return F.filter(lines, lambda x: x["kind"] != "skip")


def report_markup(kept: Column) -> Column:
    """Markup of the kept lines; a list opens and closes where runs of bullets do."""
    edge = F.array(F.struct(F.lit("blank").alias("kind"), F.lit("").alias("line")))
    none = F.array().cast("array<string>")
    # Each line next to the one before it; the closing edge ends a list on the last line.
    pieces = F.zip_with(
        F.concat(kept, edge),
        F.concat(edge, kept),
        lambda here, before: F.concat(
            F.when(
                (before["kind"] == "bullet") & (here["kind"] != "bullet"), F.array(F.lit("</ul>"))
            ).otherwise(none),
            F.when(
                (before["kind"] != "bullet") & (here["kind"] == "bullet"), F.array(F.lit("<ul>"))
            ).otherwise(none),
            F.array_compact(F.array(_tagged(here["kind"], here["line"]))),
        ),
    )
    return strip(F.array_join(F.flatten(pieces), "\n"))
