"""The corpus pipeline: each stage reads all that the one before it kept, as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm import common, decontaminate, exact_dedup, simhash, toxicity
from loadlens.llm.catalog import encoded_digests
from loadlens.scratch import discard


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half stay; the score is learned from the labels table."""
    model = toxicity.train(docs, common.table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.score(model) < 0.5)


def _exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, that with the largest id."""
    found = exact_dedup.exact_dedup(docs)
    keep = found.filter("doc_id <=> keep_id").select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__kept")
    )
    marked = docs.withColumn("__digest", exact_dedup.text_digest("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__kept"))
    kept = marked.join(keep, same, "left_semi")
    return kept.dropDuplicates(["doc_id", "__digest"]).select(docs.columns)


def _near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, that with the smallest id (no id comes last); of
    several with that id the one whose text has the smallest digest."""
    digest = F.sha2(common.text_of("text"), 256)
    found = simhash.simhash_dedup(docs, carry={"digest": digest})
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("first")
    keep = found.groupBy("root").agg(first).select(
        F.col("first.doc_id").alias("__id"), F.col("first.digest").alias("__kept")
    )
    marked = docs.withColumn("__digest", digest)
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__kept"))
    kept = marked.join(keep, same, "left_semi")
    return kept.dropDuplicates(["doc_id", "__digest"]).select(docs.columns)


def _clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark stay."""
    benchmark = common.table(spark, sf_dir, "benchmark")
    found = decontaminate.find_contamination(docs, benchmark, out="__hit")
    return found.filter("__hit.n_hit = 0").select(docs.columns)


def _encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document left, and the digest of what they decode to."""
    return encoded_digests(docs)


STAGES = [
    ("toxicity", _toxicity),
    ("exact dedup", _exact),
    ("simhash near-dedup", _near),
    ("benchmark decontamination", _clean),
    ("byte-level BPE", _encode),
]

#: Fingerprints and learned scores have no form in SQL; tests/llm checks the run by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What one keeps is written to the shared folder, and removed when
    the next has written its own."""
    docs, before = common.table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        path = common.own_folder(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            discard(spark, before)
        before = path
    return docs
