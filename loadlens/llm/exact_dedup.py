"""Exact de-duplication by salted digest groups, with the full content compared at every stage."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.llm.common import cut, is_empty, release, text_of

#: A digest is hot from this share of all rows on, so at most 1 / HOT_SHARE digests are hot.
HOT_SHARE = 1 / 1024


@F.arrow_udf(T.BinaryType())
def _digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        lowered = pc.ascii_lower(texts)
        yield pa.array([hashlib.sha256(x.as_buffer()).digest() for x in lowered], pa.binary())
    release()


_DIGEST_AND_NORM = T.StructType(
    [T.StructField("digest", T.BinaryType()), T.StructField("norm", T.StringType())]
)


@F.arrow_udf(_DIGEST_AND_NORM)
def _digest_and_norm(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        lowered = pc.ascii_lower(texts).cast(pa.string())
        digests = pa.array([hashlib.sha256(x.as_buffer()).digest() for x in lowered], pa.binary())
        yield pa.StructArray.from_arrays([digests, lowered], ["digest", "norm"])
    release()


def text_digest(column: str) -> Column:
    """SHA-256 of the text with A-Z lowered; null counts as empty."""
    return _digest(text_of(column))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    salts: int = 32,
    key_bytes: int = 32,
) -> DataFrame:
    """For every row, which row of its group of equal texts stays: ``doc_id, digest, keep_id, group_size``.

    Texts are equal when identical after lowering A-Z. The row with the largest id stays.

    1. One scan gives a digest per row. Digests that hold at least ``HOT_SHARE`` of all rows are
       hot; there can be no more than ``1 / HOT_SHARE`` of them, so they are broadcast.
    2. A second scan groups by digest, salt and full text. The partial step de-duplicates within
       each task, so a group costs one row per task and salt, and its texts are compared in full.
       Only hot digests have more than one salt.
    3. The salts' winners of the hot digests are grouped by digest and full text again. Every other
       digest is finished after stage 2, so no text moves twice.
    4. A digest with several texts (a collision; with SHA-256 none is known) is resolved by
       grouping and joining its rows on the text itself.

    Null texts are empty texts. A null id loses against any other id; a group of null ids only has
    a null ``keep_id``. Rows that repeat an id count in ``group_size`` one by one. An empty table
    gives no rows. Other columns are not read. ``key_bytes`` shortens the digest that groups
    (tests make collisions with it).
    """
    base = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    narrow = cut(
        base.select("doc_id", _digest("text").alias("digest")).withColumn(
            "key", F.substring("digest", 1, key_bytes)
        )
    )
    least = max(2, int(narrow.count() * HOT_SHARE))
    hot = cut(narrow.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") >= least))
    hot = hot.select("key", F.lit(True).alias("hot"))

    def with_text(extra: list[Column]) -> DataFrame:
        return base.select("doc_id", _digest_and_norm("text").alias("d")).select(
            "doc_id", F.substring("d.digest", 1, key_bytes).alias("key"), "d.norm", *extra
        )

    salted = (
        with_text([])
        .join(F.broadcast(hot), "key", "left")
        .withColumn(
            "salt",
            F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(salts))).otherwise(F.lit(0)),
        )
    )
    by_salt = salted.groupBy("key", "hot", "salt", "norm").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("size")
    )
    # Cold rows carry no text from here on: each of them is one whole group already.
    merged = by_salt.groupBy("key", "hot", F.when(F.col("hot"), F.col("norm")).alias("norm")).agg(
        F.max("keep_id").alias("keep_id"), F.sum("size").alias("size"), F.count("*").alias("parts")
    )
    winners = cut(
        merged.groupBy("key", "hot").agg(
            F.max("keep_id").alias("keep_id"),
            F.sum("size").alias("group_size"),
            F.sum(F.when(F.col("hot"), 1).otherwise(F.col("parts"))).alias("texts"),
        )
    )
    whole = winners.filter("texts = 1").select("key", "keep_id", "group_size", "hot")
    flagged = narrow.join(F.broadcast(hot), "key", "left")
    columns = ["doc_id", "digest", "keep_id", "group_size"]
    out = (
        flagged.filter("hot")
        .join(F.broadcast(whole.filter("hot").drop("hot")), "key")
        .select(columns)
        .unionByName(
            flagged.filter("hot IS NULL")
            .join(whole.filter("hot IS NULL").drop("hot"), "key")
            .select(columns)
        )
    )
    collided = winners.filter("texts > 1").select("key")
    if is_empty(collided):
        return out
    rows = with_text([F.col("d.digest")]).join(collided, "key", "left_semi")
    texts = rows.groupBy("norm").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    return out.unionByName(rows.join(texts, "norm").select(columns))
