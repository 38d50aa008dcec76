"""Small frames for the operators of the training-data pipeline."""

from __future__ import annotations


def documents(spark, rows):
    """Rows of (doc_id, text) with the other columns of documents, some of clashing names."""
    full = [(i, t, "en", "src", len(t or ""), f"x{n}", n) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(
        full,
        "doc_id long, text string, lang string, source string, n_chars long, key string, fp long",
    )


def table(df, *order):
    return sorted(tuple(r) for r in df.select(*order).collect())
