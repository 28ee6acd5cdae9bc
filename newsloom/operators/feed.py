"""From feed rows to today's news: filter, one row per URL, order, counts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.fixed_values import FEED_ZONE
from newsloom.functions.language import (
    PORTUGUESE,
    LanguageRule,
    active_rules,
    in_brazil,
    translation_mask,
    url_mask,
)
from newsloom.functions.times import iso_local, iso_utc, local_day, local_wall, within_local_day

DEFAULT_RULES = (PORTUGUESE,)


def today(feed: DataFrame, as_of: datetime, zone: str = FEED_ZONE) -> DataFrame:
    """Rows of the local day of ``as_of``; rows without a date go."""
    return feed.filter(within_local_day(F.col("date_utc"), as_of, zone))


def with_language_hits(feed: DataFrame, rules: tuple[LanguageRule, ...]) -> DataFrame:
    """Adds ``url_hit`` and ``translation_hit``."""
    return feed.withColumns(
        {
            "url_hit": url_mask(F.col("url"), rules),
            "translation_hit": translation_mask(F.col("translation"), rules),
        }
    )


def in_languages(
    feed: DataFrame,
    wanted: frozenset[str],
    rules: tuple[LanguageRule, ...] = DEFAULT_RULES,
) -> DataFrame:
    """Rows whose URL or translation note shows a wanted language.

    Only languages with a rule can be tested; when the wanted set names none of
    them, every row stays.
    """
    active = active_rules(wanted, rules)
    if not active:
        return feed
    return feed.filter(
        translation_mask(F.col("translation"), active) | url_mask(F.col("url"), active)
    )


def about_brazil(feed: DataFrame) -> DataFrame:
    return feed.filter(in_brazil(F.col("locations")))


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of every key in the given order.

    Each task keeps one row per key before the shuffle (``WindowGroupLimit``),
    so a key that holds a third of all rows, such as the empty URL, sends one
    row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn("_place", F.row_number().over(window))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def one_per_url(feed: DataFrame) -> DataFrame:
    """One row per URL: the least slot and line; all empty URLs make one row."""
    return first_per_key(feed, ["url"], ["slot", "row_no"])


def newest_order() -> list[Column]:
    return [F.col("date_utc").desc_nulls_last(), F.col("url")]


def newest_first(feed: DataFrame) -> DataFrame:
    return feed.orderBy(*newest_order())


def newest(feed: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` rows (a top-k: no full sort)."""
    return feed.orderBy(*newest_order()).limit(n)


def with_dates(feed: DataFrame, zone: str = FEED_ZONE) -> DataFrame:
    """Adds the local wall clock, both ISO texts and the local day."""
    at = F.col("date_utc")
    return feed.withColumns(
        {
            "date_local": local_wall(at, zone),
            "date_local_iso": iso_local(at, zone),
            "date_utc_iso": iso_utc(at),
            "local_day": local_day(at, zone),
        }
    )


def daily_news(
    feed: DataFrame,
    as_of: datetime,
    zone: str = FEED_ZONE,
    wanted: frozenset[str] = frozenset({"POR"}),
    brazil: bool = False,
    rules: tuple[LanguageRule, ...] = DEFAULT_RULES,
) -> DataFrame:
    """Day, language and place filters, then one row per URL; unsorted."""
    rows = in_languages(today(feed, as_of, zone), wanted, rules)
    if brazil:
        rows = about_brazil(rows)
    return with_dates(one_per_url(rows), zone)


def funnel(
    feed: DataFrame,
    in_day: Column,
    wanted: frozenset[str] = frozenset({"POR"}),
    brazil: bool = False,
    rules: tuple[LanguageRule, ...] = DEFAULT_RULES,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """What each filter kept, in one pass; null where a step was off or had no input.

    The distinct count is planned on (url) first, so a hot URL is folded on the
    map side.
    """
    active = active_rules(wanted, rules)
    rows = with_language_hits(feed, active).withColumn("_day", F.coalesce(in_day, F.lit(False)))
    speaks = F.col("_day")
    if active:
        speaks = F.col("_day") & (F.col("url_hit") | F.col("translation_hit"))
    kept = speaks & in_brazil(F.col("locations")) if brazil else speaks
    rows = rows.select(
        *by,
        "_day",
        (F.col("_day") & F.col("url_hit")).alias("_url_hit"),
        (F.col("_day") & F.col("translation_hit")).alias("_translation_hit"),
        speaks.alias("_speaks"),
        kept.alias("_kept"),
        F.when(kept, F.col("url")).alias("_kept_url"),
    )
    off = F.lit(None).cast("bigint")
    counts = rows.groupBy(*by).agg(
        F.count("*").alias("rows_read"),
        F.count_if("_day").alias("in_day"),
        (F.count_if("_url_hit") if active else off).alias("url_hits"),
        (F.count_if("_translation_hit") if active else off).alias("translation_hits"),
        F.count_if("_speaks").alias("after_language"),
        F.count_if("_kept").alias("_after_place"),
        F.count_distinct("_kept_url").alias("after_dedup"),
    )
    after_place = F.when(F.col("after_language") > 0, F.col("_after_place")) if brazil else off
    return counts.select(
        *by,
        "rows_read",
        "in_day",
        "url_hits",
        "translation_hits",
        "after_language",
        after_place.alias("after_place"),
        "after_dedup",
    )


class CountedNews:
    """News of the day whose funnel is counted on the way, as metrics of the job that writes them.

    ``news`` is a DataFrame; once it has been written, ``funnel`` gives the row that ``funnel`` the
    function gives in a pass of its own. The last count is of rows behind the dedup, so no
    distinct count is needed. Write it as it stands, then sort: a limit ends tasks early, and the
    sampling of a sort runs the last step twice, which would count double.
    """

    def __init__(
        self,
        feed: DataFrame,
        in_day: Column,
        zone: str = FEED_ZONE,
        wanted: frozenset[str] = frozenset({"POR"}),
        brazil: bool = False,
        rules: tuple[LanguageRule, ...] = DEFAULT_RULES,
    ):
        active = active_rules(wanted, rules)
        self.active, self.brazil = bool(active), brazil
        self.read, self.kept = Observation(), Observation()
        day, url, note = F.col("_day"), F.col("url_hit"), F.col("translation_hit")
        rows = with_language_hits(feed, active).withColumn("_day", F.coalesce(in_day, F.lit(False)))
        rows = rows.withColumn("_speaks", day & (url | note) if active else day)
        place = F.col("_speaks") & in_brazil(F.col("locations")) if brazil else F.col("_speaks")
        rows = rows.withColumn("_kept", F.coalesce(place, F.lit(False))).observe(
            self.read,
            F.count(F.lit(1)).alias("rows_read"),
            F.count_if(day).alias("in_day"),
            F.count_if(day & url).alias("url_hits"),
            F.count_if(day & note).alias("translation_hits"),
            F.count_if("_speaks").alias("after_language"),
            F.count_if("_kept").alias("after_place"),
        )
        own = ["url_hit", "translation_hit", "_day", "_speaks", "_kept"]
        single = one_per_url(rows.where("_kept").drop(*own))
        self.news = with_dates(single.observe(self.kept, F.count(F.lit(1)).alias("after_dedup")), zone)

    def funnel(self, spark: SparkSession) -> DataFrame:
        """One row of counts; null where a step was off or had no input."""
        counts = {**self.read.get, **self.kept.get}
        if not self.active:
            counts.update(url_hits=None, translation_hits=None)
        if not self.brazil or not counts["after_language"]:
            counts["after_place"] = None
        names = ["rows_read", "in_day", "url_hits", "translation_hits", "after_language", "after_place", "after_dedup"]
        schema = ", ".join(f"{n} bigint" for n in names)
        return spark.createDataFrame([tuple(counts[n] for n in names)], schema)
