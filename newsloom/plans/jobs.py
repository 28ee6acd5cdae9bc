"""Whole jobs on landed files and tables. Each step hands a written table to the next."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed
from newsloom.functions.language import PORTUGUESE, LanguageRule
from newsloom.functions.style import style_context
from newsloom.functions.times import within_local_day
from newsloom.functions.videos import channel_handle, clean_title, video_id
from newsloom.operators.articles import enrich_newest
from newsloom.operators.corpus import blocks as cut_blocks
from newsloom.operators.feed import CountedNews, first_per_key
from newsloom.operators.fusion import book_document, style_books
from newsloom.operators.responses import analyses, prompts
from newsloom.operators.slots import arrival_counts, manifest, missing_slots
from newsloom.operators.transcripts import (
    clean_texts,
    latest_per_title,
    preferred_language,
    segments_to_text,
)
from newsloom.operators.videos import channel_links
from newsloom.session import stored, utc_session
from newsloom.sources.keyed_table import KeyedTable
from newsloom.sources.landing import land
from newsloom.sources.package_source import (
    accepted,
    landed_lines,
    line_rejects,
    package_rejects,
    read_rows,
)
from newsloom.sources.sinks import (
    text_table,
    upsert_texts,
    write_feed,
    write_json_documents,
    write_links,
)
from newsloom.sources.texts import ordered_links
from newsloom.sources.texts import style_books as read_books


@dataclass(frozen=True)
class FeedResult:
    news: DataFrame
    funnel: DataFrame
    arrivals: DataFrame
    missing: DataFrame
    rejects: DataFrame
    line_rejects: DataFrame


def run_feed(
    spark: SparkSession,
    packages: str,
    out: str,
    as_of: datetime,
    zone: str = fixed.FEED_ZONE,
    wanted: frozenset[str] = frozenset({fixed.PT_CODE}),
    brazil: bool = False,
    window_minutes: int = 0,
    fmt: str = "parquet",
    rules: tuple[LanguageRule, ...] = (PORTUGUESE,),
    pages: DataFrame | None = None,
    articles: int = fixed.ARTICLE_LIMIT,
    landed: str | None = None,
) -> FeedResult:
    """Today's news from landed packages, with article text when ``pages`` is given.

    Only packages of the manifest's slots are opened, each once. With ``landed``, a folder
    that later runs find again, those that an earlier run has read stay closed. What each
    filter kept is counted while the news are written.
    """
    utc_session(spark)
    expected = manifest(spark, as_of, zone, window_minutes)
    # At most 100 slots a day: bounded by the arguments.
    due = [row.slot for row in expected.select("slot").collect()]
    if landed is None:
        lines = landed_lines(spark, packages).where(F.col("slot").isin(due))
        rows = stored(read_rows(lines), "packages")
    else:
        rows = land(spark, packages, landed, due).rows

    feed = accepted(rows)
    in_day = within_local_day(F.col("date_utc"), as_of, zone)
    counted = CountedNews(feed, in_day, zone, wanted, brazil, rules)
    news = stored(counted.news, "news")
    if pages is not None:
        news = enrich_newest(news, pages, articles)
    write_feed(news, out, fmt)
    arrived = feed.select("slot")
    return FeedResult(
        news=news,
        funnel=counted.funnel(spark),
        arrivals=arrival_counts(expected, arrived),
        missing=missing_slots(expected, arrived),
        rejects=package_rejects(rows),
        line_rejects=line_rejects(rows),
    )


def transcript_texts(
    links: DataFrame, segments: DataFrame, titles: DataFrame
) -> DataFrame:
    """``(file_name, text)`` of raw transcripts, one per title, the last link winning.

    ``links(pos, video_id)``, ``segments(video_id, language, seg_no, text)``,
    ``titles(video_id, title)``. The winner of a title is settled on the narrow
    columns, before any text is put together.
    """
    wanted = preferred_language(segments.join(links.select("video_id").distinct(), "video_id",
                                              "left_semi"))
    spoken = wanted.select("video_id").distinct()
    named = links.join(spoken, "video_id", "left_semi").join(titles, "video_id", "left")
    named = named.select(
        "pos", "video_id", clean_title(F.col("title"), F.col("video_id")).alias("title")
    )
    winners = latest_per_title(named).select("video_id", "title")
    texts = segments_to_text(wanted).join(winners, "video_id")
    return texts.select(F.concat("title", F.lit(".txt")).alias("file_name"), "text")


def run_prompts(
    texts: DataFrame,
    out: str,
    max_chars: int = fixed.BLOCK_CHARS,
    clean_first: bool = False,
    **prompt_options,
) -> DataFrame:
    """Cut corpora into blocks, write them below ``out`` and return their prompts."""
    path = f"{out.rstrip('/')}/blocks"
    cut_blocks(texts, max_chars, clean_first).write.mode("overwrite").parquet(path)
    return prompts(texts.sparkSession.read.parquet(path), **prompt_options)


def run_style(
    blocks: DataFrame,
    responses: DataFrame,
    out: str,
    as_of: datetime,
    max_items: int = fixed.LIST_ITEMS,
) -> DataFrame:
    """Analyses, style books and contexts below ``out``; returns the books.

    A corpus whose blocks all failed has a record of that in place of its book, and no context.
    """
    spark = blocks.sparkSession
    base = out.rstrip("/")
    analysed = stored(analyses(blocks, responses), "analyses")
    document = F.coalesce(
        F.to_json("analysis", {"ignoreNullFields": "false"}), F.to_json("error")
    )
    analysed.select("corpus_key", "block_no", document.alias("json")).write.mode(
        "overwrite"
    ).parquet(f"{base}/partials")
    books = stored(style_books(analysed, as_of, max_items), "books")
    books.select("corpus_key", book_document().alias("json")).write.mode("overwrite").parquet(f"{base}/books")
    made = books.where("book IS NOT NULL")
    write_json_documents(made, ["corpus_key"], style_context(F.col("book")), f"{base}/contexts")
    return read_books(spark, f"{base}/books")


def run_transcripts(
    links: DataFrame, segments: DataFrame, titles: DataFrame, raw_out: str, clean_out: str
) -> None:
    """Raw transcripts, then their clean texts, under the same names.

    Texts of names that are there already are replaced; all others stay, with their files.
    """
    texts = stored(transcript_texts(links, segments, titles), "transcripts")
    upsert_texts(texts, raw_out)
    upsert_texts(clean_texts(texts), clean_out)


def run_all(
    links: DataFrame,
    segments: DataFrame,
    titles: DataFrame,
    corpus_key: str,
    out: str,
    max_chars: int = 2000,
    **prompt_options,
) -> DataFrame:
    """Transcripts, cleaning, blocks and prompts of one channel; responses come later."""
    base = out.rstrip("/")
    run_transcripts(links, segments, titles, f"{base}/raw", f"{base}/clean")
    texts = text_table(links.sparkSession, f"{base}/clean").read().withColumn(
        "corpus_key", F.lit(corpus_key)
    )
    return run_prompts(texts, base, max_chars, **prompt_options)


CHANNEL_TEXTS = "corpus_key string, file_name string, text string"


def channel_texts(spark: SparkSession, path: str) -> KeyedTable:
    """Texts of many channels on disk, by channel and file name."""
    return KeyedTable(spark, path, CHANNEL_TEXTS, ["corpus_key", "file_name"])


def run_channels(
    channels: DataFrame,
    listing: DataFrame,
    segments: DataFrame,
    titles: DataFrame,
    out: str,
    kind: str = "both",
    limit: int = 10,
    max_chars: int = 2000,
    **prompt_options,
) -> DataFrame:
    """From a list of channels to prompts: links, transcripts, clean texts and blocks of all of them.

    ``channels(channel_url)`` as ``texts.channel_lines`` reads it, ``listing(channel, kind, pos, video_id)`` with
    channels by their handles, ``segments`` and ``titles`` as in ``transcript_texts``. The links
    of each channel are written in order and read back with their positions, as a later
    run may start there. A channel is a corpus; of videos with one title in a
    channel the last link's text stays. Below ``out``: ``links``, ``raw``, ``clean``, ``blocks``.
    """
    spark, base = channels.sparkSession, out.rstrip("/")
    handles = channels.select(channel_handle(F.col("channel_url")).alias("channel")).distinct()
    chosen = channel_links(listing.join(handles, "channel", "left_semi"), kind, limit)
    kinds = chosen.withColumn("kind", F.lit(kind)).withColumn("pos", F.struct("channel", "place"))
    lines = kinds.withColumn("url", F.concat_ws("\t", "channel", "url"))
    write_links(lines, f"{base}/links", by=("kind",))
    links = ordered_links(spark, f"{base}/links", "kind string").select(
        F.split_part("url", F.lit("\t"), F.lit(1)).alias("channel"), "pos", video_id(F.col("url")).alias("video_id")
    )
    links = stored(links, "links")
    wanted = preferred_language(
        segments.join(links.select("video_id").distinct(), "video_id", "left_semi")
    )
    spoken = wanted.select("video_id").distinct()
    named = links.join(spoken, "video_id", "left_semi").join(titles, "video_id", "left")
    named = named.select(
        "channel", "pos", "video_id", clean_title(F.col("title"), F.col("video_id")).alias("title")
    )
    last = first_per_key(named, ["channel", "title"], [F.col("pos").desc()])
    texts = segments_to_text(wanted).join(last.select("channel", "title", "video_id"), "video_id")
    named_texts = texts.select(
        F.col("channel").alias("corpus_key"), F.concat("title", F.lit(".txt")).alias("file_name"), "text"
    )
    # A title of a channel is there once; both tables take the rows as they lie, so texts are dealt out once.
    table = channel_texts(spark, f"{base}/raw")
    raw = table.laid_out(named_texts, "raw")
    table.upsert(raw, laid_out=True)
    clean = channel_texts(spark, f"{base}/clean")
    clean.upsert(clean_texts(raw), laid_out=True)
    return run_prompts(clean.read(), base, max_chars, **prompt_options)
