"""Run registered queries and their SQL side by side.

``python -m tests.compare SF_DIR [name ...]`` prints one line per query.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import tempfile
import time
from datetime import datetime
from decimal import Decimal

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    """One form for a value, whichever engine it came from."""
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, bytearray):
        return bytes(value)
    return value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return names, sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def differences(spark_df, con, sql: str, limit: int = 3) -> list[str]:
    """What differs between the two results; empty if they agree in names, types and values."""
    names, ours = table_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    described = [d[0] for d in cursor.description]
    theirs_names, theirs = table_of(described, cursor.fetchall())
    if names != theirs_names:
        return [f"columns {names} != {theirs_names}"]
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} != {len(theirs)}", str(ours[:1]), str(theirs[:1])]
    out = []
    for a, b in zip(ours, theirs, strict=True):
        same = a == b and [type(x) for x in a] == [type(x) for x in b]
        if not same:
            out.append(f"{a} != {b}")
            if len(out) == limit:
                break
    return out


def session(cores: int = 4):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("loadlens")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="loadlens-test-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry

    spark, con = session(), duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or sorted(queries):
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                found = differences(df, con, oracles[name])
                verdict = "ok" if not found else "DIFF " + " | ".join(found)
            else:
                verdict = f"rows {df.count()}"
        except Exception as problem:  # noqa: BLE001 - a report of everything that fails
            found = [str(problem)]
            verdict = "FAIL " + str(problem)[:1500]
        bad += verdict.startswith(("DIFF", "FAIL"))
        print(f"{name:32s} {time.time() - start:6.2f}s {verdict}", flush=True)
        spark.catalog.clearCache()
    print(f"{bad} bad", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
