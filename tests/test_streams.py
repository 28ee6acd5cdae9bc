"""Streams against batch on the same packages."""

import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from newsloom.operators.feed import one_per_url
from newsloom.sources import package_source
from newsloom.sources.packages import feed_rows, package_files, read_packages
from newsloom.streaming import feed_stream


def package(folder, stamp, urls):
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as archive:
        lines = ["\t".join(["", stamp, "", "s", url] + [""] * 22) for url in urls]
        archive.writestr("x.csv", "\n".join(lines))
    (folder / f"{stamp}.gkg.csv.zip").write_bytes(body.getvalue())


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


def run(spark, tmp_path, stream):
    out = str(tmp_path / "out")
    feed_stream.run_available(stream, out, str(tmp_path / "checkpoint"))
    return spark.read.schema(stream.schema).parquet(out)


def test_ingest_in_drops_equals_batch(spark, landing, tmp_path):
    for stamp, urls in [("20250825100000", ["a", "b"]), ("20250825101500", ["", "c"])]:
        package(landing, stamp, urls)
        rows = run(spark, tmp_path, feed_stream.feed_stream(spark, str(landing)))
    (landing / "20250825103000.gkg.csv.zip").write_bytes(b"broken")
    rows = run(spark, tmp_path, feed_stream.feed_stream(spark, str(landing)))
    batch = feed_rows(read_packages(package_files(spark, str(landing))))
    assert rows.count() == 4
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, batch.collect()))


def test_one_row_per_url_over_runs(spark, landing, tmp_path):
    package(landing, "20250825100000", ["a", "b", "a", "", ""])
    stream = feed_stream.first_arrivals(feed_stream.feed_stream(spark, str(landing)))
    run(spark, tmp_path, stream)
    package(landing, "20250825101500", ["a", "c", ""])
    stream = feed_stream.first_arrivals(feed_stream.feed_stream(spark, str(landing)))
    rows = run(spark, tmp_path, stream)
    batch = one_per_url(feed_rows(read_packages(package_files(spark, str(landing)))))
    key = lambda frame: sorted((r.url, r.slot, r.row_no) for r in frame.collect())
    assert key(rows) == key(batch)


def test_slots_are_given_once_the_watermark_passed(spark, landing, tmp_path):
    package(landing, "20250825100000", ["a", "b"])
    package(landing, "20250825101459", ["c", ""])
    package(landing, "20250825101500", ["d"])
    package(landing, "20250825120000", ["closing"])
    stream = feed_stream.slot_statistics(
        feed_stream.feed_stream(spark, str(landing)), F.col("url") != "", "30 minutes"
    )
    rows = run(spark, tmp_path, stream)
    found = sorted((r.slot, r["rows"], r.kept_rows) for r in rows.collect())
    assert found == [("20250825100000", 4, 3), ("20250825101500", 1, 1)]


def test_late_repeats_do_not_take_rows_in_time_along(spark, landing, tmp_path):
    def first():
        return feed_stream.first_arrivals(feed_stream.feed_stream(spark, str(landing)))

    package(landing, "20240120000000", ["A"])
    run(spark, tmp_path, first())
    package(landing, "20240101000000", ["X", "late"])
    package(landing, "20240120010000", ["X", "A"])
    package(landing, "99991231235959", ["far"])
    package(landing, "15000101000000", ["old"])
    out = str(tmp_path / "out")
    dropped = feed_stream.run_available(first(), out, str(tmp_path / "checkpoint"))
    found = {(r.url, r.slot) for r in spark.read.parquet(out).collect()}
    assert found == {("A", "20240120000000"), ("X", "20240120010000"), ("far", "99991231235959")}
    assert dropped == 3


def test_bad_packages_are_kept_as_rejects(spark, landing, tmp_path):
    package(landing, "20250825100000", ["http://a.pt/"])
    (landing / "20250825103000.gkg.csv.zip").write_bytes(b"broken")
    out, rejects = str(tmp_path / "news"), str(tmp_path / "rejects")
    for _ in range(2):
        feed_stream.run_news(spark, str(landing), out, str(tmp_path / "state"), rejects=rejects)
    found = spark.read.parquet(rejects).collect()
    assert [r.slot for r in found] == ["20250825103000"] and "BadZipFile" in found[0].error


def test_news_are_appended_by_day(spark, landing, tmp_path):
    out, checkpoint = str(tmp_path / "news"), str(tmp_path / "state")
    package(landing, "20250825100000", ["http://a.pt/", "http://b.com/", "http://a.pt/"])
    feed_stream.run_news(spark, str(landing), out, checkpoint)
    package(landing, "20250826030000", ["http://a.pt/", "http://c.br/"])
    package(landing, "20250826041500", ["http://d.br/"])
    feed_stream.run_news(spark, str(landing), out, checkpoint)
    found = sorted((str(r.local_day), r.url) for r in spark.read.parquet(out).collect())
    assert found == [
        ("2025-08-25", "http://a.pt/"), ("2025-08-25", "http://c.br/"), ("2025-08-26", "http://d.br/")
    ]


def news(spark, landing, tmp_path, name, **more):
    """A run of the stream job; returns what it has written so far, and the ingest's tables."""
    state = str(tmp_path / f"{name}-state")
    feed_stream.run_news(spark, str(landing), str(tmp_path / name), state, **more)
    out = tmp_path / name
    written = spark.read.parquet(str(out)).collect() if list(out.rglob("*.parquet")) else []
    return written, feed_stream.Ingest(spark, str(landing), f"{state}-packages")


def test_least_rows_over_shuffled_drops_equal_the_batch(spark, landing, tmp_path):
    draw = random.Random(12)
    stamps = [f"202508{d:02d}{h:02d}0000" for d in (1, 2, 3) for h in range(0, 24, 3)]
    drops = [stamps[:9], stamps[9:16], stamps[16:]]
    # Within the delay packages come in any order, also in another drop than their neighbours'.
    drops[0][8], drops[1][0] = drops[1][0], drops[0][8]
    for drop in drops:
        for stamp in draw.sample(drop, len(drop)):
            package(landing, stamp, [f"http://{draw.choice('abcdef')}.pt/" for _ in range(3)])
        news(spark, landing, tmp_path, "least", least=True, delay="2 days")
    package(landing, "20250820000000", ["http://closing.pt/"])
    package(landing, "20250827000000", ["http://closing.pt/"])
    news(spark, landing, tmp_path, "least", least=True, delay="2 days")
    package(landing, "20250901000000", ["http://end.pt/"])
    found, ingest = news(spark, landing, tmp_path, "least", least=True, delay="2 days")
    batch = one_per_url(feed_rows(read_packages(package_files(spark, str(landing)))))
    expected = {(r.url, r.slot, r.row_no) for r in batch.collect() if "closing" not in r.url and "end" not in r.url}
    assert {(r.url, r.slot, r.row_no) for r in found if "closing" not in r.url} == expected
    assert len([r for r in found if "closing" not in r.url]) == len(expected) == 6
    assert ingest.of_kind("late").count() == 0


def test_everything_that_lands_is_kept(spark, landing, tmp_path):
    package(landing, "20250825100000", ["http://a.pt/"])
    (landing / "20250825103000.gkg.csv.zip").write_bytes(b"broken")
    news(spark, landing, tmp_path, "all")
    package(landing, "20250801000000", ["http://late.pt/", "http://a.pt/"])
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as archive:
        short = ["", "no date", "", "s", "http://undated.pt/"] + [""] * 3
        archive.writestr("x.csv", "\n".join("\t".join(x) for x in (short, short + ["more"])))
    (landing / "20250825104500.gkg.csv.zip").write_bytes(body.getvalue())
    _, ingest = news(spark, landing, tmp_path, "all")
    kinds = {k: [(r.slot, r.url) for r in ingest.of_kind(k).orderBy("row_no").collect()] for k in ("late", "undated", "line", "row")}
    assert kinds == {
        "late": [("20250801000000", "http://late.pt/"), ("20250801000000", "http://a.pt/")],
        "undated": [("20250825104500", "http://undated.pt/")],
        "line": [("20250825104500", "http://undated.pt/")],
        "row": [("20250825100000", "http://a.pt/")],
    }
    assert [(r.slot, r.error.split(":")[0]) for r in ingest.of_kind("package").collect()] == [("20250825103000", "BadZipFile")]
    assert ingest.of_kind("line").first().line.endswith("more")


def test_a_batch_done_again_takes_the_place_of_its_first_try(spark, landing, tmp_path):
    package(landing, "20250825100000", ["a", "b"])
    ingest = feed_stream.Ingest(spark, str(landing), str(tmp_path / "p"))
    ingest.run()
    batch = package_source.lines_of_files(package_files(spark, str(landing)))
    ingest._write(batch, 0)
    assert ingest.of_kind("row").count() == 2
    assert spark.read.parquet(ingest.clock).count() == 1


def test_rows_exactly_a_delay_apart_are_two_stories(spark, tmp_path):
    schema = "url string, date_utc timestamp, slot string, row_no long"
    days = [("a", 1, 0), ("a", 4, 0), ("b", 1, 1), ("b", 4, 0), ("closing", 20, 0)]
    times = [(url, f"2024-01-{day:02d} 00:00:{second:02d}", f"s{day:02d}") for url, day, second in days]
    rows = spark.createDataFrame(times, "url string, d string, slot string").selectExpr(
        "url", "CAST(d AS timestamp) AS date_utc", "slot", "0L AS row_no"
    )
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    found = run(spark, tmp_path, feed_stream.least_arrivals(stream, "3 days")).collect()
    assert sorted((r.url, r.slot) for r in found) == [("a", "s01"), ("a", "s04"), ("b", "s01")]
