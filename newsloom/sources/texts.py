"""Readers of text folders, link and channel lists, and style books."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions.cleaning import strip
from newsloom.operators.fusion import FAILED_TYPE
from newsloom.operators.responses import BOOK_TYPE, NOT_MERGED


def _file_name() -> Column:
    """The name of the file a row is from; Spark gives it percent-encoded."""
    encoded = F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(encoded).alias("file_name")


def text_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(file_name, text)`` of every ``*.txt``; bytes that are not UTF-8 are left out."""
    files = spark.read.option("pathGlobFilter", "*.txt").text(folder, wholetext=True)
    valid = F.replace(F.make_valid_utf8(F.col("value")), F.lit("�"), F.lit(""))
    return files.select(_file_name(), valid.alias("text"))


def link_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file_name, url)``, stripped, no blank lines."""
    lines = spark.read.text(path)
    return lines.select(_file_name(), strip(F.col("value")).alias("url")).filter(
        F.col("url") != ""
    )


def ordered_links(spark: SparkSession, path: str, by: str = "") -> DataFrame:
    """``(<by>, pos, url)`` of link lists, ``pos`` from 1 in the order of files and lines; no blank lines.

    ``by`` are the folder columns of ``sinks.write_links``, as a schema. Lines are numbered within
    each split of a file; only the splits' counts, one short row each, are put in order
    and summed, so a very long list is never one task.
    """
    schema = f"value string, {by}" if by else "value string"
    names = [f.name for f in spark.createDataFrame([], schema).schema][1:]
    meta = F.col("_metadata")
    split = ["_file", "_start"]
    lines = (
        spark.read.schema(schema)
        .text(path)
        .select(
            *names,
            meta["file_name"].alias("_file"),
            meta["file_block_start"].alias("_start"),
            strip(F.col("value")).alias("url"),
        )
        .where("url <> ''")
        .withColumn("_line", F.monotonically_increasing_id())
    )
    counts = lines.groupBy(*names, *split).agg(F.count("*").alias("_n"), F.min("_line").alias("_first"))
    before = Window.partitionBy(*names).orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    pos = F.col("_before") + F.col("_line") - F.col("_first") + 1
    return lines.join(offsets, [*names, *split]).select(*names, pos.alias("pos"), "url")


def channel_lines(
    spark: SparkSession, path: str | None, default: Sequence[str] = ()
) -> DataFrame:
    """``channel_url`` without blank and ``#`` lines; the default list when none is left."""
    fallback = spark.createDataFrame([(u,) for u in default], "channel_url string")
    if path is None:
        return fallback
    listed = (
        link_lines(spark, path)
        .filter(~F.startswith(F.col("url"), F.lit("#")))
        .select(F.col("url").alias("channel_url"))
    )
    return fallback if listed.isEmpty() else listed


def style_books(spark: SparkSession, path: str) -> DataFrame:
    """``(corpus_key, book, error)`` as the style job writes them: a book, or why there is none."""
    rows = spark.read.schema("corpus_key string, json string").parquet(path)
    failed = F.from_json("json", FAILED_TYPE)
    is_failed = F.coalesce(failed[NOT_MERGED], F.lit(False))
    return rows.select(
        "corpus_key",
        F.when(~is_failed, F.from_json("json", BOOK_TYPE)).alias("book"),
        F.when(is_failed, failed).alias("error"),
    )
