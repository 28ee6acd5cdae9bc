import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from newsloom.functions.times import within_local_day
from newsloom.operators import feed
from newsloom.operators.articles import enrich_newest

AS_OF = datetime(2025, 8, 25, 15, 30, tzinfo=timezone.utc)
SCHEMA = (
    "slot string, row_no long, date string, source string, url string, themes string, "
    "locations string, tone string, translation string"
)


def frame(spark, rows):
    full = [
        (slot, no, date, "s", url, "", place, "", note) for slot, no, date, url, place, note in rows
    ]
    return spark.createDataFrame(full, SCHEMA).withColumn(
        "date_utc", F.try_to_timestamp("date", F.lit("yyyyMMddHHmmss"))
    )


@pytest.fixture
def rows(spark):
    return frame(
        spark,
        [
            ("1", 0, "20250825100000", "http://a.pt/", "Brazil", ""),
            ("1", 1, "20250825110000", "http://a.pt/", "", ""),
            ("2", 0, "20250825120000", "http://x.com/", "BRA", "srclc:por"),
            ("2", 1, "20250825130000", "", "Brazil", "srclc:por"),
            ("3", 0, "20250825140000", "", "Brazil", "srclc:por"),
            ("3", 1, "20250824140000", "http://b.pt/", "Brazil", ""),
            ("3", 2, "bad", "http://c.pt/", "Brazil", ""),
            ("3", 3, "20250825150000", "http://y.com/", "Brazil", "srclc:spa"),
        ],
    )


def test_daily_news(rows):
    news = feed.newest_first(feed.daily_news(rows, AS_OF)).collect()
    assert [(r.url, r.slot, r.row_no) for r in news] == [
        ("", "2", 1), ("http://x.com/", "2", 0), ("http://a.pt/", "1", 0)
    ]
    assert news[0].date_local_iso == "2025-08-25 09:00:00-0400"
    assert news[0].date_local.isoformat() == "2025-08-25T09:00:00"


def test_place_step(rows):
    news = feed.daily_news(rows, AS_OF, brazil=True)
    assert sorted(r.url for r in news.collect()) == ["", "http://a.pt/", "http://x.com/"]


def test_other_languages_switch_the_filter_off(rows):
    assert feed.in_languages(rows, frozenset({"ENG"})).count() == 8
    assert feed.in_languages(rows, frozenset()).count() == 8
    assert feed.in_languages(rows, frozenset({"ENG", "POR"})).count() == 7


def test_funnel(rows):
    in_day = within_local_day(F.col("date_utc"), AS_OF, "America/Boa_Vista")
    found = feed.funnel(rows, in_day, brazil=True).first().asDict()
    assert found == {
        "rows_read": 8, "in_day": 6, "url_hits": 2, "translation_hits": 3,
        "after_language": 5, "after_place": 4, "after_dedup": 3,
    }
    off = feed.funnel(rows, in_day, frozenset({"ENG"})).first().asDict()
    assert off == {
        "rows_read": 8, "in_day": 6, "url_hits": None, "translation_hits": None,
        "after_language": 6, "after_place": None, "after_dedup": 4,
    }
    none = feed.funnel(rows, F.lit(False), brazil=True).first()
    assert (none.after_language, none.after_place, none.after_dedup) == (0, None, 0)


def test_ties_and_dates_that_are_missing_come_last(spark):
    rows = frame(spark, [
        ("1", 0, "bad", "a", "", ""), ("1", 1, "20250825100000", "c", "", ""),
        ("1", 2, "20250825100000", "b", "", ""), ("1", 3, "20250825110000", "d", "", ""),
    ])
    assert [r.url for r in feed.newest_first(rows).collect()] == ["d", "b", "c", "a"]
    assert [r.url for r in feed.newest(rows, 2).collect()] == ["d", "b"]


def test_hot_key_is_cut_before_the_shuffle(rows):
    plan = feed.one_per_url(rows)._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_top_needs_no_full_sort(rows):
    plan = feed.newest(rows, 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_empty_feed_keeps_its_columns(spark, rows):
    news = feed.daily_news(rows.filter("false"), AS_OF)
    assert news.count() == 0
    assert {"date_local", "date_local_iso", "date_utc_iso", "local_day"} <= set(news.columns)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    out = enrich_newest(news, pages)
    assert out.count() == 0
    assert {"title", "text", "lang", "fetch_status"} <= set(out.columns)


def test_enrichment(spark, rows):
    news = feed.one_per_url(rows)
    article = "<p>" + "word " * 60 + "</p>"
    pages = spark.createDataFrame(
        [
            (2, "http://y.com/", "<title>later copy</title>" + article),
            (1, "http://y.com/", f"<html lang='pt'><title>One</title>{article}"),
            (3, "http://x.com/", "<title>T</title><p>short</p>"),
            (4, "http://b.pt/", "never looked at"),
        ],
        "page_id long, url string, html string",
    )
    found = {r.url: r for r in enrich_newest(news, pages, 4).collect()}
    assert len(found) == 6
    assert (found["http://y.com/"].title, found["http://y.com/"].lang) == ("One", "pt")
    assert found["http://y.com/"].fetch_status == "ok"
    assert found["http://x.com/"].fetch_status == "extract-weak"
    assert found["http://x.com/"].text == "short"
    assert found[""].fetch_status == "fetch-failed"
    assert found["http://a.pt/"].fetch_status == "fetch-failed"
    assert found["http://b.pt/"].fetch_status is None and found["http://b.pt/"].text is None


def ancestors(plan, *words):
    """Operators above the first plan line that holds all words, nearest first."""
    steps = [re.match(r"([ :]*[+:]- )(.*)", line) for line in plan.splitlines()]
    steps = [(len(step[1]), step[2]) for step in steps if step]
    depth, lines = zip(*steps)
    at = next(i for i, line in enumerate(lines) if all(w in line for w in words))
    found, level = [], depth[at]
    for i in range(at - 1, -1, -1):
        if depth[i] < level:
            found.append(lines[i])
            level = depth[i]
    return found


def test_pages_are_not_shuffled_whole(spark, rows, tmp_path):
    pages = spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "pages"))
    stored = spark.read.parquet(str(tmp_path / "pages"))
    plan = enrich_newest(feed.one_per_url(rows), stored, 3)
    above = ancestors(plan._jdf.queryExecution().executedPlan().toString(), "FileScan", "html#")
    taken_apart = next(i for i, step in enumerate(above) if "ArrowEvalPython" in step)
    steps = above[:taken_apart]
    assert any("BroadcastHashJoin" in step for step in steps)
    assert not any("Exchange" in step or "Sort" in step for step in steps)
