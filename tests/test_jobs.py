"""Whole jobs on small landed inputs."""

import io
import zipfile
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from newsloom import __main__ as command
from newsloom.functions.times import within_local_day
from newsloom.operators.feed import CountedNews, funnel
from newsloom.plans import jobs
from newsloom.sources import package_source

AS_OF = datetime(2025, 8, 25, 5, 7, tzinfo=timezone.utc)


def land(folder, stamp, rows):
    body = io.BytesIO()
    lines = []
    for date, url, place, note in rows:
        cells = [""] * 27
        cells[1], cells[3], cells[4], cells[10], cells[25] = date, "s", url, place, note
        lines.append("\t".join(cells))
    with zipfile.ZipFile(body, "w") as archive:
        archive.writestr("x.csv", "\n".join(lines))
    (folder / f"{stamp}.gkg.csv.zip").write_bytes(body.getvalue())


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    land(folder, "20250825040000", [
        ("20250825040000", "http://a.pt/", "Brazil", ""),
        ("20250825035959", "http://yesterday.pt/", "Brazil", ""),
        ("20250825040100", "http://x.com/", "", "srclc:eng"),
    ])
    land(folder, "20250825041500", [
        ("20250825041500", "http://a.pt/", "Brazil", ""),
        ("20250825041500", "http://b.com/", "", "srclc:por"),
    ])
    land(folder, "20250824230000", [("20250825050000", "http://not-due.pt/", "", "")])
    (folder / "20250825043000.gkg.csv.zip").write_bytes(b"broken")
    return str(folder)


def test_feed_job(spark, landing, tmp_path):
    out = str(tmp_path / "out")
    result = jobs.run_feed(spark, landing, out, AS_OF)
    written = spark.read.parquet(out)
    assert sorted((r.url, r.slot) for r in written.collect()) == [
        ("http://a.pt/", "20250825040000"), ("http://b.com/", "20250825041500")
    ]
    assert result.news.count() == 2
    funnel = result.funnel.first()
    assert (funnel.rows_read, funnel.in_day, funnel.after_language, funnel.after_dedup) == (5, 4, 3, 2)
    arrivals = result.arrivals.first()
    assert (arrivals.ok, arrivals.missing) == (2, 3)
    assert "20250825043000" in {r.slot for r in result.missing.collect()}
    assert [r.slot for r in result.rejects.collect()] == ["20250825043000"]


def test_feed_job_opens_a_package_once(spark, landing, tmp_path):
    table, out = str(tmp_path / "landed"), str(tmp_path / "out")
    first = jobs.run_feed(spark, landing, out, AS_OF, landed=table)
    assert (first.funnel.first().rows_read, first.arrivals.first().ok) == (5, 2)
    folder = tmp_path / "landing"
    for stamp in ("20250825040000", "20250825041500"):
        (folder / f"{stamp}.gkg.csv.zip").write_bytes(b"not read again")
    land(folder, "20250825044500", [("20250825044500", "http://late.pt/", "Brazil", "")])
    second = jobs.run_feed(spark, landing, out, AS_OF, landed=table)
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["http://a.pt/", "http://b.com/", "http://late.pt/"]
    assert (second.funnel.first().rows_read, second.arrivals.first().ok) == (6, 3)
    assert [r.slot for r in second.rejects.collect()] == ["20250825043000"]


@pytest.mark.parametrize("brazil, wanted", [(True, {"POR"}), (False, {"POR"}), (True, set()), (True, {"XXX"})])
def test_funnel_on_the_way_equals_its_own_pass(spark, landing, tmp_path, brazil, wanted):
    rows = package_source.accepted(package_source.read_rows(package_source.landed_lines(spark, landing)))
    in_day = within_local_day(F.col("date_utc"), AS_OF, "America/Boa_Vista")
    counted = CountedNews(rows, in_day, wanted=frozenset(wanted), brazil=brazil)
    counted.news.write.parquet(str(tmp_path / "news"))
    assert counted.funnel(spark).collect() == funnel(rows, in_day, frozenset(wanted), brazil).collect()


def test_a_corpus_that_failed_keeps_a_record(spark, tmp_path):
    blocks = spark.createDataFrame([("good", 1, "x"), ("bad", 1, "y"), ("bad", 2, "z")], "corpus_key string, block_no long, text string")
    answers = spark.createDataFrame(
        [("good", 1, '{"tom":"a"}'), ("bad", 1, "oops")], "corpus_key string, block_no long, response string"
    )
    base = str(tmp_path / "style")
    books = {r.corpus_key: r for r in jobs.run_style(blocks, answers, base, AS_OF).collect()}
    assert books["good"].book.tom == "a" and books["good"].error is None
    assert books["bad"].book is None and books["bad"].error._mensagem == "none of 2 blocks was analysed"
    assert books["bad"].error.versao == books["good"].book.versao
    assert [r.corpus_key for r in spark.read.parquet(f"{base}/contexts").collect()] == ["good"]


def test_feed_job_with_text_place_and_window(spark, landing, tmp_path):
    pages = spark.createDataFrame(
        [(1, "http://a.pt/", "<html lang='pt'><title>A</title><p>" + "x " * 150)],
        "page_id long, url string, html string",
    )
    out = str(tmp_path / "out")
    result = jobs.run_feed(
        spark, landing, out, AS_OF, brazil=True, window_minutes=60, fmt="json", pages=pages, articles=1
    )
    rows = result.news.collect()
    assert [(r.url, r.title, r.lang, r.fetch_status) for r in rows] == [("http://a.pt/", "A", "pt", "ok")]
    assert spark.read.json(out).count() == 1


def test_transcript_and_style_jobs(spark, tmp_path):
    links = spark.createDataFrame([(1, "v1"), (2, "v2"), (3, "v3"), (4, "v4")], "pos int, video_id string")
    segments = spark.createDataFrame(
        [("v1", "pt", 0, "0:01 velho"), ("v2", "pt", 0, "0:01 Oi"), ("v2", "pt", 1, "[risos] tudo"),
         ("v3", "pt-BR", 0, "Bom dia"), ("v4", "en", 0, "hi"), ("v9", "pt", 0, "not linked")],
        "video_id string, language string, seg_no int, text string",
    )
    titles = spark.createDataFrame([("v1", "T?"), ("v2", "T"), ("v4", "E")], "video_id string, title string")
    base = str(tmp_path / "style")
    prompts = jobs.run_all(links, segments, titles, "canal", base, max_chars=7)
    clean = {r.file_name: r.text for r in spark.read.parquet(f"{base}/clean").collect()}
    assert clean == {"T.txt": "Oi tudo", "v3.txt": "Bom dia"}
    rows = prompts.orderBy("block_no").collect()
    assert [r.block_no for r in rows] == [1, 2]
    assert rows[0].prompt.endswith("Oi tudo\n\n") and rows[1].prompt.endswith("Bom dia\n")

    responses = spark.createDataFrame(
        [("canal", 1, '{"tom": "leve", "bordoes": [{"texto": "oi"}]}'), ("canal", 2, "oops")],
        "corpus_key string, block_no long, response string",
    )
    books = jobs.run_style(spark.read.parquet(f"{base}/blocks"), responses, base, AS_OF)
    book = books.first().book
    assert (book.tom, book.bordoes[0].texto, book.bordoes[0].peso) == ("leve", "oi", 1.0)
    partials = {r.block_no: r.json for r in spark.read.parquet(f"{base}/partials").collect()}
    assert "_erro_parse_json" in partials[2] and '"tom":"leve"' in partials[1]
    context = spark.read.parquet(f"{base}/contexts").first().json
    assert '"bordoes":["oi"]' in context and '"pausas":null' in context


def test_command_line(spark, landing, tmp_path):
    out = str(tmp_path / "news")
    command.run(spark, ["feed", "--packages", landing, "--out", out, "--as-of", "2025-08-25T05:07",
                        "--languages", "--format", "csv"])
    back = spark.read.option("header", "true").csv(out)
    assert sorted(r.url for r in back.collect()) == ["http://a.pt/", "http://b.com/", "http://x.com/"]

    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.txt").write_text("0:01 Oi\n\ntudo")
    (raw / "b.txt").write_text("[risos] bem")
    base = str(tmp_path / "style")
    command.run(spark, ["clean", "--texts", str(raw), "--out", f"{base}/clean"])
    assert sorted(r.text for r in spark.read.parquet(f"{base}/clean").collect()) == ["Oi tudo", "bem"]
    command.run(spark, ["prompts", "--texts", str(raw), "--corpus", "k", "--out", base,
                        "--clean-first", "--max-items", "9"])
    prompt = spark.read.parquet(f"{base}/prompts").first()
    assert prompt.corpus_key == "k" and "Oi tudo\n\nbem" in prompt.prompt and "9 itens" in prompt.prompt
    answers = spark.createDataFrame([("k", 1, '{"tom": "x"}')], "corpus_key string, block_no long, response string")
    answers.write.parquet(f"{base}/answers")
    command.run(spark, ["books", "--blocks", f"{base}/blocks", "--responses", f"{base}/answers", "--out", base])
    assert '"tom":"x"' in spark.read.parquet(f"{base}/books").first().json
