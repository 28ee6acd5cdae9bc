"""From raw documents to token ids: five stages, each stored and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

import newsloom
from newsloom.llm import bpe, compression, decontamination, jaccard_join, personal_data
from newsloom.llm.common import table
from newsloom.session import small_batches, stored

cloudpickle.register_pickle_by_value(newsloom)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity classifier rejects."""
    model = compression.train_toxicity(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    rows = docs.select(F.struct("*").alias("document"), "text")
    return compression.toxicity(rows, model, ["document"]).where("predicted = 0").select("document.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that with the least id.

    A document is known by its id and text, so rows that share an id and differ in text are
    judged each for itself; of equal rows one stays. Rows without an id all stay.
    """
    key = F.xxhash64("doc_id", "text")
    known = docs.where("doc_id IS NOT NULL")
    classes = jaccard_join.near_duplicates(known.select(key.alias("doc_id"), "text"))
    members = known.select("doc_id", key.alias("key")).join(
        classes.select(F.col("doc_id").alias("key"), "component_id").distinct(), "key"
    )
    kept = members.groupBy("component_id").agg(F.min(F.struct("doc_id", "key"))["key"].alias("key"))
    rows = known.select(F.struct("*").alias("document"), key.alias("key")).join(kept.select("key"), "key", "left_semi")
    first = F.row_number().over(W.partitionBy("key").orderBy("key"))
    single = rows.withColumn("place", first).where("place = 1").select("document.*")
    return single.union(docs.where("doc_id IS NULL"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents; a row is known by its id and text."""
    key = F.xxhash64("doc_id", "text")
    found = decontamination.contamination(
        docs.select(key.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    )
    bad = found.where("contaminated").select(F.col("doc_id").alias("key")).distinct()
    rows = docs.select(F.struct("*").alias("document"), key.alias("key"))
    return rows.join(bad, "key", "left_anti").select("document.*")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind in the place of each span; ``n_chars`` follows the text."""
    found = personal_data.redacted(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", length)
    return found.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, checked by decoding them."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def _bounded(stage: Callable) -> Callable:
    """The stage with small batches for Python, as processes outlive their stage and share an executor's memory."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(small_batches(spark), docs, sf_dir)

    return run


STAGES = [
    ("toxicity", _bounded(without_toxic)),
    ("jaccard_join", _bounded(without_copies)),
    ("decontamination", _bounded(without_benchmark)),
    ("personal_data", _bounded(without_personal_data)),
    ("bpe", _bounded(tokens)),
]

#: Compression, wrappers and merges have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
