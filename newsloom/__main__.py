"""Jobs from the command line, for ``spark-submit`` or ``python -m newsloom``."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed
from newsloom.functions.language import wanted_languages
from newsloom.operators.transcripts import clean_texts
from newsloom.plans import jobs
from newsloom.session import utc_session
from newsloom.sources.sinks import FEED_FORMATS, upsert_texts
from newsloom.sources.texts import text_files
from newsloom.streaming.feed_stream import run_news


def moment(text: str) -> datetime:
    at = datetime.fromisoformat(text)
    return at if at.tzinfo else at.replace(tzinfo=timezone.utc)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="newsloom")
    jobs_of = top.add_subparsers(dest="job", required=True)

    feed = jobs_of.add_parser("feed", help="news of the day from landed packages")
    feed.add_argument("--packages", required=True)
    feed.add_argument("--out", required=True)
    feed.add_argument("--as-of", type=moment, default=None)
    feed.add_argument("--zone", default=fixed.FEED_ZONE)
    feed.add_argument("--languages", nargs="?", const="", default=fixed.PT_CODE)
    feed.add_argument("--brazil", action="store_true")
    feed.add_argument("--window-minutes", type=int, default=0)
    feed.add_argument("--format", choices=FEED_FORMATS, default="parquet")
    feed.add_argument("--pages", help="table (page_id, url, html): adds article text")
    feed.add_argument("--articles", type=int, default=fixed.ARTICLE_LIMIT)

    feed.add_argument("--landed", help="table of opened packages, kept between runs")

    stream = jobs_of.add_parser("stream", help="news from the packages landed since the last run")
    stream.add_argument("--packages", required=True)
    stream.add_argument("--out", required=True)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--zone", default=fixed.FEED_ZONE)
    stream.add_argument("--languages", nargs="?", const="", default=fixed.PT_CODE)
    stream.add_argument("--brazil", action="store_true")

    stream.add_argument("--delay", default="1 day", help="how long after its date a row may come")
    stream.add_argument("--least", action="store_true", help="hold a URL until its least row is certain")

    clean = jobs_of.add_parser("clean", help="clean a folder of transcripts")
    clean.add_argument("--texts", required=True)
    clean.add_argument("--out", required=True)

    prompts = jobs_of.add_parser("prompts", help="blocks and prompts of a folder of texts")
    prompts.add_argument("--texts", required=True)
    prompts.add_argument("--corpus", required=True)
    prompts.add_argument("--out", required=True)
    prompts.add_argument("--max-chars", type=int, default=fixed.BLOCK_CHARS)
    prompts.add_argument("--max-items", type=int, default=fixed.LIST_ITEMS)
    prompts.add_argument("--language", default=fixed.STYLE_LANGUAGE)
    prompts.add_argument("--clean-first", action="store_true")

    books = jobs_of.add_parser("books", help="style books and contexts from responses")
    books.add_argument("--blocks", required=True)
    books.add_argument("--responses", required=True)
    books.add_argument("--out", required=True)
    books.add_argument("--as-of", type=moment, default=None)
    books.add_argument("--max-items", type=int, default=fixed.LIST_ITEMS)
    return top


def run(spark: SparkSession, arguments: list[str] | None = None) -> None:
    given = parser().parse_args(arguments)
    utc_session(spark)
    if given.job == "feed":
        result = jobs.run_feed(
            spark,
            given.packages,
            given.out,
            given.as_of or datetime.now(timezone.utc),
            given.zone,
            wanted_languages(given.languages),
            given.brazil,
            given.window_minutes,
            given.format,
            pages=spark.read.parquet(given.pages) if given.pages else None,
            articles=given.articles,
            landed=given.landed,
        )
        result.arrivals.show()
        result.funnel.show()
        result.rejects.show()
    elif given.job == "stream":
        late = run_news(
            spark,
            given.packages,
            given.out,
            given.checkpoint,
            given.zone,
            wanted_languages(given.languages),
            given.brazil,
            delay=given.delay,
            least=given.least,
        )
        print(f"{late} late rows in {given.checkpoint.rstrip('/')}-packages")
    elif given.job == "clean":
        upsert_texts(clean_texts(text_files(spark, given.texts)), given.out)
    elif given.job == "prompts":
        texts = text_files(spark, given.texts).withColumn("corpus_key", F.lit(given.corpus))
        filled = jobs.run_prompts(
            texts,
            given.out,
            given.max_chars,
            given.clean_first,
            language=given.language,
            max_items=given.max_items,
        )
        filled.write.mode("overwrite").parquet(f"{given.out.rstrip('/')}/prompts")
    else:
        jobs.run_style(
            spark.read.parquet(given.blocks),
            spark.read.parquet(given.responses),
            given.out,
            given.as_of or datetime.now(timezone.utc),
            given.max_items,
        )


if __name__ == "__main__":
    run(SparkSession.builder.appName("newsloom").getOrCreate())
