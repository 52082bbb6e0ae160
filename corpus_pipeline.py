"""Corpus pipeline: ``documents`` in, packed training sequences out.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet below the shared checkpoint folder and read again as the next
stage's ``docs``. All stages but the last keep the columns of ``documents``.
No stage is expressible in SQL as a whole, so ``ORACLE_SQL`` is None and
``tests/llm/test_pipeline.py`` holds ``run()`` against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiscope.llm import decontam, exact_dedup, langid, minhash, packing
from regiscope.llm.common import store
from regiscope.session import prepare


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents without a determinable language: NULL texts and texts
    without a letter. Learns from every labelled document; if none is labelled,
    only such texts go."""
    prepare(spark)
    model = langid.fit(docs)
    if not model["langs"]:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    got = langid.predict(docs, model, lang_out="__lang_pred", score_out="__lang_score")
    return got.where(F.col("__lang_pred") != langid.UNDETERMINED).select(*[F.col(f"`{c}`") for c in docs.columns])


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the greatest doc_id stays, once even
    where its row is repeated."""
    prepare(spark)
    found = store(exact_dedup.dedup(docs).select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"), "kept", "n_rows"), "pipeline-exact")
    gone, again = found.where(~F.col("kept")), found.where("kept and n_rows > 1")
    rows = docs.withColumn("__sha256", exact_dedup.digest())
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__sha256") == F.col("__sha"))
    kept = rows.join(gone, same, "left_anti")
    if again.limit(1).count():
        once = rows.join(again, same, "left_semi").dropDuplicates(["doc_id", "__sha256"])
        kept = kept.join(again, same, "left_anti").unionByName(once)
    return kept.drop("__sha256")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: five-word shingles,
    similarity 0.8 or more, the least doc_id."""
    prepare(spark)
    gone = store(minhash.near_duplicates(docs, k=5, similarity=(80, 100)).where(~F.col("kept")).select(
        F.col("doc_id").alias("__id"), F.col("row_hash").alias("__gone")), "pipeline-near")
    return _without(docs, gone)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold at least half of a benchmark item."""
    prepare(spark)
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    row = F.struct(F.col("doc_id").alias("id"), F.xxhash64("doc_id", "text").alias("h"))
    found = decontam.contamination(docs.select(row.alias("__row"), "text"), items, id_col="__row").where("contaminated")
    gone = store(found.select(F.col("__row.id").alias("__id"), F.col("__row.h").alias("__gone")).distinct(),
                 "pipeline-benchmark")
    return _without(docs, gone)


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` less the rows of ``gone``: told by the id, and among rows that
    share one by the hash of id and text."""
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("doc_id", "text") == F.col("__gone"))
    return docs.join(gone, same, "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of what is left, each a sequence."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near),
          ("decontamination", benchmark), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
