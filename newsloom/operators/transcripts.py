"""Transcript segments and texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.fixed_values import TRANSCRIPT_LANGUAGES
from newsloom.functions.cleaning import clean_text
from newsloom.operators.feed import first_per_key

def preferred_language(
    segments: DataFrame, languages: Sequence[str] = tuple(TRANSCRIPT_LANGUAGES)
) -> DataFrame:
    """Segments in the first wanted language each video has; other videos go.

    The ranking is folded on the map side to one row per video; in the join
    AQE splits a video that holds a large share of the segments.
    """
    wanted = F.array(*[F.lit(name) for name in languages])
    ranked = segments.withColumn("_rank", F.array_position(wanted, F.col("language"))).filter(
        F.col("_rank") > 0
    )
    best = ranked.groupBy("video_id").agg(F.min("_rank").alias("_rank"))
    return ranked.join(best, ["video_id", "_rank"], "left_semi").drop("_rank")


def segments_to_text(segments: DataFrame) -> DataFrame:
    """``(video_id, text)``: all segments of a video in order, one per line.

    A group is one video, so its length is bounded by the longest video.
    """
    line = F.struct("seg_no", "text")
    ordered = F.transform(F.array_sort(F.collect_list(line)), lambda s: s["text"])
    return segments.groupBy("video_id").agg(F.array_join(ordered, "\n").alias("text"))


def latest_per_title(texts: DataFrame) -> DataFrame:
    """Of the texts with one title the last written (greatest ``pos``) stays."""
    return first_per_key(texts, ["title"], [F.col("pos").desc(), F.col("video_id").desc()])


def replaced_titles(titles: DataFrame) -> DataFrame:
    """The videos whose text a later one of the same title replaced."""
    kept = latest_per_title(titles.select("title", "pos", "video_id")).select("video_id", "pos")
    return titles.join(kept, ["video_id", "pos"], "left_anti")


def clean_texts(texts: DataFrame) -> DataFrame:
    """Raw to clean under the same key."""
    return texts.withColumn("text", clean_text(F.col("text")))
