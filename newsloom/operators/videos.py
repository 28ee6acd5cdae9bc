"""Video lists of channels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.cleaning import strip
from newsloom.functions.videos import watch_url
from newsloom.operators.feed import first_per_key

KINDS = ("videos", "shorts", "both")


def listed_ids(listing: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` ids of each channel tab, blank ones left out before counting.

    ``row_number() <= limit`` is cut per task before the shuffle, so a channel
    with very many rows does not gather in one task.
    """
    rows = listing.withColumn("video_id", strip(F.col("video_id"))).filter(
        F.col("video_id") != ""
    )
    window = Window.partitionBy("channel", "kind").orderBy("pos", "video_id")
    return (
        rows.withColumn("_place", F.row_number().over(window))
        .filter(F.col("_place") <= limit)
        .select("channel", "kind", "pos", "video_id")
    )


def channel_links(listing: DataFrame, kind: str, limit: int) -> DataFrame:
    """``(channel, place, video_id, url)`` by the kind policy.

    ``videos`` falls back to shorts where a channel has no videos; ``both``
    puts videos before shorts and keeps an id once. Every step after the first
    sees at most two times ``limit`` rows per channel.
    """
    if kind not in KINDS:
        raise ValueError(f"kind is one of {KINDS}")
    ids = listed_ids(listing, limit).withColumn(
        "rank", F.when(F.col("kind") == "videos", 0).when(F.col("kind") == "shorts", 1)
    )
    ids = ids.filter(F.col("rank").isNotNull())
    if kind == "videos":
        best = F.min("rank").over(Window.partitionBy("channel"))
        ids = ids.withColumn("_best", best).filter(F.col("rank") == F.col("_best"))
    elif kind == "shorts":
        ids = ids.filter(F.col("rank") == 1)
    else:
        ids = first_per_key(ids, ["channel", "video_id"], ["rank", "pos"])
    window = Window.partitionBy("channel").orderBy("rank", "pos", "video_id")
    return (
        ids.withColumn("place", F.row_number().over(window))
        .filter(F.col("place") <= limit)
        .select("channel", "place", "video_id", watch_url(F.col("video_id")).alias("url"))
    )


def link_totals(links: DataFrame) -> DataFrame:
    """Links per channel and, with a null channel, in all."""
    return links.rollup("channel").agg(F.count("*").alias("links"))


def rejected_videos(
    links: DataFrame, transcripts: DataFrame, failures: DataFrame | None = None
) -> DataFrame:
    """Links without a transcript, with the reason when ``(video_id, reason)`` is known."""
    gone = links.join(transcripts.select("video_id").distinct(), "video_id", "left_anti")
    if failures is None:
        return gone.withColumn("reason", F.lit("no-transcript"))
    known = failures.groupBy("video_id").agg(F.min("reason").alias("reason"))
    return gone.join(known, "video_id", "left").withColumn(
        "reason", F.coalesce("reason", F.lit("no-transcript"))
    )
