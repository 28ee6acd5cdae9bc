"""The driver's queries over these operators: whole tables, production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import (
    bpe,
    chat_format,
    compression,
    decontamination,
    embedding_dedup,
    filter_audit,
    hard_negatives,
    jaccard_join,
    line_dedup,
    personal_data,
    token_files,
    wrappers,
)
from newsloom.llm.common import table
from newsloom.llm.sql import SQL
from newsloom.session import scratch_path, stored


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(
        table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    )


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_tokens(docs, tokenizer, public_tokenizers.PATTERN, 2, path, added_tokens=True)
    return token_files.read_tokens(spark, path)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "\\### Assistant: </turn> ok"
    planted = spark.createDataFrame(
        [(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(planted)
    return chat_format.read_back(stored(chat_format.formatted(turns), "formatted"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        table(spark, sf_dir, "documents", "doc_id", "text"),
        table(spark, sf_dir, "benchmark", "item_id", "text"),
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        "contaminated",
        F.size("near_item_ids").cast("long").alias("n_near_items"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = compression.train_toxicity(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    found = compression.toxicity(docs, model, ["doc_id"])
    return found.select("doc_id", compression.held_out().alias("held_out"), "score", "predicted")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = compression.train_quality(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    found = compression.quality(docs, model, ["doc_id"])
    return found.select("doc_id", compression.held_out().alias("held_out"), "score", "predicted")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = hard_negatives.floored(F.col("embedding"))
    return hard_negatives.hard_negatives(
        rows.select("vec_id", moved.alias("label"), whole.alias("vector")), F.col("vec_id") % 100 == 0
    )


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.without_frequent_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(
        table(spark, sf_dir, "documents", "doc_id", "text", "source"),
        table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"),
    )


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_personal_data": op2_personal_data,
    "op3_wrappers": op3_wrappers,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_token_files": op5_token_files,
    "op6_chat_format": op6_chat_format,
    "op7_decontamination": op7_decontamination,
    "op8_toxicity": op8_toxicity,
    "op9_quality": op9_quality,
    "op10_bpe": op10_bpe,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_line_dedup": op12_line_dedup,
    "op13_filter_audit": op13_filter_audit,
}
__all__ = ["QUERIES", "SQL"]
