"""Stored pages that can be looked up by URL without reading them all.

Pages lie in ``bucket=<top bits of the URL's hash>``, within a bucket sorted by the whole hash. A
lookup names the buckets and hashes it wants as literals: other buckets are not
opened, and of a file only the row groups and pages whose range holds a wanted hash are
read. The number of keys of a lookup is bounded by its parameter, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 256
#: Keys of a lookup go into the plan as literals up to this many; beyond it they are joined.
LITERAL_KEYS = 10_000
STORE_SCHEMA = "url string, page_id bigint, html string, url_hash bigint, bucket int"
ROWS_PER_PAGE = 1_000


def _hash() -> Column:
    return F.xxhash64("url")


def _bucket(url_hash: Column, buckets: int) -> Column:
    """Equal ranges of hashes, in order; ``buckets`` is a power of two."""
    bits = buckets.bit_length() - 1
    if buckets != 1 << bits or not bits:
        raise ValueError("the number of buckets is a power of two, at least 2")
    return (F.shiftright(url_hash, 64 - bits) + buckets // 2).cast("int")


def write_pages(pages: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """``(url, page_id, html)`` as a store. A row with a null URL cannot be looked up and stays out.

    The range partitioning cuts by hash and page, so a URL that is stored very often is
    spread over tasks and files.
    """
    rows = pages.where("url IS NOT NULL").select("url", "page_id", "html", _hash().alias("url_hash"))
    rows = rows.withColumn("bucket", _bucket(F.col("url_hash"), buckets))
    order = ["bucket", "url_hash", "page_id"]
    (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("parquet.page.row.count.limit", ROWS_PER_PAGE)
        .partitionBy("bucket")
        .parquet(path)
    )


class PageStore:
    """Pages written by ``write_pages`` with the same number of buckets."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets

    def pages(self) -> DataFrame:
        return self.spark.read.schema(STORE_SCHEMA).parquet(self.path)

    def lookup(self, urls: DataFrame, most: int) -> DataFrame:
        """``(url, page_id, html)`` of the first ``most`` distinct URLs: of a URL stored many times
        the page with the least ``page_id``, of equal ones the least text."""
        keys = urls.select("url").where("url IS NOT NULL").distinct().limit(most)
        pages = self.pages()
        if most <= LITERAL_KEYS:
            hashes = keys.select(_hash().alias("h"), _bucket(_hash(), self.buckets).alias("b")).collect()
            pages = pages.where(
                F.col("bucket").isin(sorted({r.b for r in hashes})) & F.col("url_hash").isin(sorted({r.h for r in hashes}))
            )
        found = pages.join(keys, "url", "left_semi")
        # The choice is made on narrow columns; page texts are compared among equal ids only.
        chosen = found.groupBy("url").agg(F.min("page_id").alias("page_id"))
        same = found.join(chosen, ["url", "page_id"]).select("url", "page_id", "html")
        return same.groupBy("url", "page_id").agg(F.min("html").alias("html"))
