"""Keyed tables, page stores and ordered link lists on disk."""

import os
import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators import articles
from newsloom.sources import sinks, texts
from newsloom.sources.keyed_table import KeyedTable
from newsloom.sources.page_store import PageStore, write_pages


def files(path):
    return {
        os.path.join(top, name)
        for top, _, names in os.walk(path)
        for name in names
        if name.startswith("part-") and "bucket=" in top
    }


def table(spark, path, buckets=8):
    return KeyedTable(spark, path, "k string, v int", ["k"], buckets)


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "k string, v int")


def test_upsert_touches_the_buckets_of_its_keys_only(spark, tmp_path):
    path = str(tmp_path / "t")
    first = table(spark, path).upsert(rows(spark, [(f"k{i}", i) for i in range(100)]))
    assert first == list(range(8))
    before = files(path)
    changed = table(spark, path).upsert(rows(spark, [("k3", -3), ("new", 7)]))
    assert 1 <= len(changed) <= 2
    after = files(path)
    bucket = lambda name: int(name.split("bucket=")[1].split("/")[0])
    assert {f for f in before if bucket(f) not in changed} == {f for f in after if bucket(f) not in changed}
    assert not {f for f in before & after if bucket(f) in changed}
    expected = {f"k{i}": i for i in range(100)} | {"k3": -3, "new": 7}
    found = table(spark, path).read().collect()
    assert len(found) == 101 and {r.k: r.v for r in found} == expected


def test_upserts_in_many_runs_equal_a_dict(spark, tmp_path):
    path, draw, expected = str(tmp_path / "t"), random.Random(3), {}
    for _ in range(5):
        some = [(draw.choice([None, f"k{draw.randint(0, 30)}"]), draw.randint(0, 99)) for _ in range(20)]
        last = {}
        for k, v in some:
            last[k] = min(v, last.get(k, v))
        table(spark, path, 4).upsert(rows(spark, some))
        expected |= last
        found = table(spark, path).read().collect()
        assert {r.k: r.v for r in found} == expected and len(found) == len(expected)


def test_rows_laid_out_once_go_to_two_tables(spark, tmp_path, monkeypatch):
    plans = []
    writer = type(spark.range(0).write)
    write = writer.parquet

    def noted(self, path, *args, **kwargs):
        plans.append((path, self._df._jdf.queryExecution().optimizedPlan().toString()))
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(writer, "parquet", noted)
    given = [(f"k{i}", i) for i in range(200)] + [(None, -1)]
    one, two = (table(spark, str(tmp_path / name)) for name in ("one", "two"))
    laid = one.laid_out(rows(spark, given), "laid")
    assert one.upsert(laid, laid_out=True) == list(range(8))
    assert two.upsert(laid.withColumn("v", -F.col("v")), laid_out=True) == list(range(8))
    # One exchange lays the rows out; none ranks them or writes them to either table.
    texts_moved = [plan for _, plan in plans if "Rebalance" in plan or "Window" in plan]
    assert len(texts_moved) == 1
    assert {r.k: r.v for r in one.read().collect()} == dict(given)
    assert {r.k: r.v for r in two.read().collect()} == {k: -v for k, v in given}
    assert len(files(tmp_path / "one")) == 8

    again = two.laid_out(rows(spark, [("k3", 7), (None, 8), ("new", 9)]), "again")
    two.upsert(again, laid_out=True)
    found = two.read().collect()
    expected = {k: -v for k, v in given} | {"k3": 7, None: 8, "new": 9}
    assert len(found) == len(expected) and {r.k: r.v for r in found} == expected
    assert two.upsert(again.where("false"), laid_out=True) == []


def test_a_run_that_dies_leaves_the_old_state(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path).upsert(rows(spark, [("a", 1), ("b", 2)]))
    # Rows of a version that no list names, as a run leaves them that died before its end.
    lost = rows(spark, [("a", 100)]).withColumns({"bucket": F.lit(1), "version": F.lit(99)})
    lost.write.mode("append").partitionBy("bucket", "version").parquet(path)
    assert sorted(tuple(r) for r in table(spark, path).read().collect()) == [("a", 1), ("b", 2)]
    assert table(spark, path).upsert(rows(spark, []).limit(0)) == []


def test_texts_by_name(spark, tmp_path):
    path = str(tmp_path / "texts")
    given = spark.createDataFrame([("a.txt", "1"), ("b.txt", "2\n3")], "file_name string, text string")
    sinks.upsert_texts(given, path)
    sinks.upsert_texts(given.where("file_name = 'b.txt'").withColumn("text", F.lit("new")), path)
    assert sorted(tuple(r) for r in sinks.text_table(spark, path).read().collect()) == [("a.txt", "1"), ("b.txt", "new")]


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages") / "store")
    page = "<html lang='pt'><title>T{}</title><p>" + "x " * 150
    many = [(f"http://s/{k}", k, page.format(k)) for k in range(400)]
    many += [("http://s/7", 3, page.format("least")), ("http://s/7", 3, page.format("more")), (None, 1, "x")]
    many += [("http://hot/", k + 1000, page.format("hot")) for k in range(300)]
    given = spark.createDataFrame(many, "url string, page_id long, html string")
    write_pages(given.repartition(4), path, 16)
    return path, given


def test_lookup_reads_the_wanted_buckets(spark, store):
    path, _ = store
    urls = spark.createDataFrame([("http://s/5",), ("http://s/7",), ("http://none/",)], "url string")
    found = PageStore(spark, path, 16).lookup(urls, 10)
    assert sorted((r.url, r.page_id) for r in found.collect()) == [("http://s/5", 5), ("http://s/7", 3)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "In(url_hash" in plan
    read = found.inputFiles()
    assert len({f.split("bucket=")[1].split("/")[0] for f in PageStore(spark, path, 16).pages().inputFiles()}) == 16
    assert len(read) >= 1
    one = next(r for r in found.collect() if r.url == "http://s/7")
    assert "Tleast" in one.html


def test_enrichment_from_the_store_equals_that_from_the_table(spark, store):
    path, given = store
    feed = spark.createDataFrame(
        [(f"http://s/{k}", k) for k in range(0, 500, 3)] + [("http://hot/", 900), (None, 5)], "url string, t long"
    ).select("url", F.timestamp_seconds("t").alias("date_utc"))
    for n in (1, 40, 10_000):
        mine = articles.enrich_from_store(feed, PageStore(spark, path, 16), n)
        plain = articles.enrich_newest(feed, given, n)
        key = lambda t: sorted(map(str, t.select("url", "title", "text", "lang", "fetch_status").collect()))
        assert key(mine) == key(plain)


def test_links_keep_their_order(spark, tmp_path):
    draw = random.Random(9)
    links = [("a", "both", k, f"u{draw.randint(0, 999)}-{k}") for k in range(500)] + [("b", "videos", 1, "x"), ("b", "videos", 2, "y")]
    shuffled = draw.sample(links, len(links))
    given = spark.createDataFrame(shuffled, "channel string, kind string, pos int, url string").repartition(7)
    path = str(tmp_path / "l")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_links(given, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(files(path)) == 0 and len([n for _, _, ns in os.walk(path) for n in ns if n.endswith(".txt")]) > 2
    found = texts.ordered_links(spark, path, "channel string, kind string").orderBy("channel", "kind", "pos").collect()
    assert [(r.channel, r.kind, r.url) for r in found] == [(c, k, u) for c, k, _, u in sorted(links)]
    assert [r.pos for r in found if r.channel == "a"] == list(range(1, 501))


def test_positions_go_on_over_splits_and_blank_lines(spark, tmp_path):
    lines = [f"http://a/{k}" if k % 5 else "  " for k in range(3000)]
    (tmp_path / "1.txt").write_text("\n".join(lines))
    (tmp_path / "2.txt").write_text("\n\nlast\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        found = texts.ordered_links(spark, str(tmp_path)).orderBy("pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    expected = [x for x in lines if x.strip()] + ["last"]
    assert [r.url for r in found] == expected
    assert [r.pos for r in found] == list(range(1, len(expected) + 1))
