"""Article text for the newest rows of a feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.fixed_values import ARTICLE_LIMIT, ARTICLE_MIN_CHARS
from newsloom.functions.pages import page_language, page_text, page_title, text_status
from newsloom.operators.feed import newest
from newsloom.session import stored
from newsloom.sources.page_store import PageStore

# Keys of the newest rows are broadcast up to this many; the parameter bounds them,
# not the data. Beyond it Spark picks the join by size. Page texts never are.
BROADCAST_KEYS = 10_000


def _keys(rows: DataFrame, n: int) -> DataFrame:
    return F.broadcast(rows) if n <= BROADCAST_KEYS else rows


def page_articles(pages: DataFrame, min_chars: int = ARTICLE_MIN_CHARS) -> DataFrame:
    """Title, text, language and status of every page."""
    return pages.withColumns(
        {
            "title": page_title(F.col("html")),
            "text": page_text(F.col("html")),
            "lang": page_language(F.col("html")),
        }
    ).withColumn("fetch_status", text_status(F.col("text"), min_chars)).drop("html")


def enrich_newest(
    feed: DataFrame,
    pages: DataFrame,
    n: int = ARTICLE_LIMIT,
    min_chars: int = ARTICLE_MIN_CHARS,
) -> DataFrame:
    """Text for the newest ``n`` rows, nulls for the rest; the feed has one row per URL.

    Of a URL stored many times the copy with the least ``page_id``, then text, counts; it is
    found on the two narrow columns, so no page text is sorted or shuffled.
    The wide pages are then cut by at most n keys, only those are taken apart,
    and they meet only the n rows. Give a feed that has been written: it is
    read three times, once for the order columns only.
    """
    urls = _keys(newest(feed, n).select("url"), n)
    copies = pages.select("url", "page_id").join(urls, "url", "left_semi")
    chosen = copies.groupBy("url").agg(F.min("page_id").alias("page_id"))
    wanted = pages.select("url", "page_id", "html").join(_keys(chosen, n), ["url", "page_id"])
    # Of rows that share URL and page_id the one with the least page counts.
    parts = ["title", "text", "lang", "fetch_status"]
    every = page_articles(wanted.withColumn("_page", F.col("html")), min_chars)
    single = every.groupBy("url").agg(F.min_by(F.struct(*parts), "_page").alias("_parts"))
    return _joined(feed, urls, single.select("url", "_parts.*"))


def _joined(feed: DataFrame, urls: DataFrame, found: DataFrame) -> DataFrame:
    top = feed.join(urls, "url", "left_semi").join(found, "url", "left")
    top = top.withColumn("fetch_status", F.coalesce("fetch_status", F.lit("fetch-failed")))
    rest = feed.join(urls, "url", "left_anti")
    return top.unionByName(rest, allowMissingColumns=True)


def enrich_from_store(
    feed: DataFrame, store: PageStore, n: int = ARTICLE_LIMIT, min_chars: int = ARTICLE_MIN_CHARS
) -> DataFrame:
    """The same from a page store: only the buckets and rows of the ``n`` URLs are read.

    The feed, which has been written and has one row per URL, is read for the order once more.
    """
    urls = stored(newest(feed, n).select("url"), "newest")
    found = page_articles(store.lookup(urls, n), min_chars).drop("page_id")
    return _joined(feed, _keys(urls, n), found)
