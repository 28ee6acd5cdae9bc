"""Sources and sinks on temporary folders."""

import glob
import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from newsloom.operators.fusion import style_books
from newsloom.operators.responses import parsed
from newsloom.operators.transcripts import clean_texts
from newsloom.sources import sinks, texts

AS_OF = datetime(2025, 8, 25, tzinfo=timezone.utc)


@pytest.fixture
def feed(spark):
    rows = [("u1", "ç\"x", 1756135800123), ("", None, None)]
    frame = spark.createDataFrame(rows, "url string, source string, ms long")
    at = F.timestamp_millis("ms")
    return frame.select("url", "source", at.alias("date_utc"), F.to_date(at).alias("local_day"))


def read_lines(path):
    return [line for f in glob.glob(f"{path}/*/part-*") for line in open(f, encoding="utf-8")]


def test_json_lines(feed, tmp_path):
    sinks.write_feed(feed, str(tmp_path / "f"), "json")
    lines = [json.loads(line) for line in read_lines(tmp_path / "f")]
    assert {"url": "u1", "source": 'ç"x', "date_utc": 1756135800123} in lines
    assert {"url": "", "source": None, "date_utc": None} in lines
    assert any("ç" in line for line in read_lines(tmp_path / "f"))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_other_formats(spark, feed, tmp_path, fmt):
    path = str(tmp_path / fmt)
    sinks.write_feed(feed, path, fmt)
    back = spark.read.option("header", "true").format(fmt).load(path)
    assert back.count() == 2 and "local_day" in back.columns
    with pytest.raises(ValueError):
        sinks.write_feed(feed, path, "xml")


def test_only_the_days_present_are_replaced(spark, feed, tmp_path):
    path = str(tmp_path / "f")
    sinks.write_feed(feed, path)
    later = feed.filter("url = 'u1'").withColumn("url", F.lit("u2"))
    sinks.write_feed(later, path)
    sinks.write_feed(later.withColumn("local_day", F.lit("2030-01-01").cast("date")), path)
    assert sorted(r.url for r in spark.read.parquet(path).collect()) == ["", "u2", "u2"]


def test_newest_first_in_the_files(spark, feed, tmp_path):
    rows = feed.filter("url = 'u1'").select("source", "date_utc", "local_day")
    many = rows.crossJoin(spark.range(50)).select(
        F.concat(F.lit("u"), "id").alias("url"), "source", "local_day",
        (F.col("date_utc") - F.make_dt_interval(mins=F.pmod(F.hash("id"), F.lit(60)))).alias("date_utc"),
    )
    sinks.write_feed(many.repartition(4), str(tmp_path / "f"), "json")
    parts = sorted(glob.glob(f"{tmp_path}/f/*/part-*"))
    dates = [json.loads(line)["date_utc"] for f in parts for line in open(f, encoding="utf-8")]
    assert len(dates) == 50 and dates == sorted(dates, reverse=True)


def test_empty_feed(spark, feed, tmp_path):
    sinks.write_feed(feed.filter("false"), str(tmp_path / "f"), "json")
    assert read_lines(tmp_path / "f") == []


def test_text_folder(spark, tmp_path):
    (tmp_path / "b ú+.txt").write_bytes("linha\n\xe9 ç".encode("utf-8") + b"\xff\xfe!")
    (tmp_path / "a.txt").write_text("0:15 oi\n[ __ ]")
    (tmp_path / "c.md").write_text("no")
    found = {r.file_name: r.text for r in texts.text_files(spark, str(tmp_path)).collect()}
    assert found == {"b ú+.txt": "linha\n\xe9 ç!", "a.txt": "0:15 oi\n[ __ ]"}
    out = str(tmp_path / "clean")
    sinks.write_texts(clean_texts(texts.text_files(spark, str(tmp_path))), out)
    clean = {r.file_name: r.text for r in spark.read.parquet(out).collect()}
    assert clean == {"b ú+.txt": "linha \xe9 ç!", "a.txt": "oi [ __ ]"}


def test_link_and_channel_lists(spark, tmp_path):
    path = tmp_path / "links.txt"
    path.write_text("  https://y/1 \n\n#https://y/2\n \t\nhttps://y/3")
    assert [r.url for r in texts.link_lines(spark, str(path)).collect()] == [
        "https://y/1", "#https://y/2", "https://y/3"
    ]
    channels = texts.channel_lines(spark, str(path), ["d"])
    assert [r.channel_url for r in channels.collect()] == ["https://y/1", "https://y/3"]
    path.write_text("\n# only a note\n")
    assert [r.channel_url for r in texts.channel_lines(spark, str(path), ["d"]).collect()] == ["d"]
    assert texts.channel_lines(spark, None, ["d", "e"]).count() == 2


def test_links_per_channel_and_kind(spark, tmp_path):
    rows = [("a", "both", "https://y/1"), ("a", "both", "https://y/2"), ("b", "both", "https://y/3")]
    links = spark.createDataFrame(rows, "channel string, kind string, url string")
    sinks.write_links(links, str(tmp_path / "l"))
    back = texts.link_lines(spark, str(tmp_path / "l/channel=a/kind=both"))
    assert sorted(r.url for r in back.collect()) == ["https://y/1", "https://y/2"]


def test_books_as_documents(spark, tmp_path):
    rows = [("k", 1, '{"tom": "x", "bordoes": [{"texto": "é"}]}')]
    analysed = parsed(spark.createDataFrame(rows, "corpus_key string, block_no int, response string"))
    path = str(tmp_path / "books")
    sinks.write_json_documents(style_books(analysed, AS_OF), ["corpus_key"], "book", path)
    raw = spark.read.parquet(path).first().json
    assert '"humor":null' in raw and "é" in raw
    back = texts.style_books(spark, path)
    assert back.first().book.bordoes[0].texto == "é"
    wanted = spark.createDataFrame([("k",), ("none",)], "corpus_key string")
    assert wanted.join(back, "corpus_key", "left").filter("book is null").count() == 1
