"""Exact de-duplication against grouping in plain Python."""

from collections import defaultdict

import pytest

from loadlens.llm import exact_dedup as module
from loadlens.llm.exact_dedup import exact_dedup
from tests.llm.helpers import documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for i, t in rows:
        ids = groups[(t or "").translate(LOWER)]
        out.append((i, max((x for x in ids if x is not None), default=None), len(ids)))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size").collect()), key=str)


ROWS = (
    [(i, "Hot Copy") for i in range(60)]
    + [(100 + i, f"text {i // 2}") for i in range(20)]
    + [(200, None), (201, ""), (202, "ÉCOLE"), (203, "École"), (204, "école"), (205, "É")]
    + [(None, "hot copy"), (None, "only null ids"), (None, "only null ids")]
    + [(300, "twice"), (300, "twice"), (301, "x" * 500_000), (302, "X" * 500_000)]
)


@pytest.mark.parametrize("key_bytes", [32, 1])
def test_groups(spark, key_bytes):
    """With a digest of one byte most groups collide, and only the full text tells them apart."""
    rows = ROWS + [(1000 + i, f"Other {i % 150}") for i in range(300)]
    assert found(exact_dedup(documents(spark, rows), key_bytes=key_bytes)) == expected(rows)


def test_hot_groups_are_salted(spark, monkeypatch):
    monkeypatch.setattr(module, "HOT_SHARE", 0.2)
    df = exact_dedup(documents(spark, ROWS).repartition(7), salts=4)
    assert found(df) == expected(ROWS)


def test_empty_table(spark):
    assert exact_dedup(documents(spark, ROWS).limit(0)).collect() == []
