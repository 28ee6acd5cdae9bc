import pytest
from pyspark.sql import functions as F

from newsloom.functions import videos
from newsloom.operators import transcripts
from newsloom.operators import videos as lists


def test_handle(one):
    urls = ["https://www.youtube.com/@a_B-1/videos", "https://youtube.com/@canção", "https://youtube.com/c/x", ""]
    assert one(urls, videos.channel_handle(F.col("v"))) == [
        "a_B-1", "canção", "canal_desconhecido", "canal_desconhecido"
    ]


def test_tab(one):
    urls = ["https://y/@a", "https://y/@a//", "https://y/@a/videos", "https://y/@a/videos/"]
    assert one(urls, videos.tab_url(F.col("v"), "videos")) == ["https://y/@a/videos"] * 4
    assert one(urls[:1], videos.tab_url(F.col("v"), "shorts")) == ["https://y/@a/shorts"]
    with pytest.raises(ValueError):
        videos.tab_url(F.col("v"), "live")


def test_video_id(one):
    urls = [
        "https://www.youtube.com/watch?v=abcDEF12_-x",
        "https://www.youtube.com/watch?v=abcDEF12_-x&t=1s",
        "https://youtu.be/9zyXWV87_-q",
        "short",
        "watch?v=a/watch?v=b",
    ]
    assert one(urls, videos.video_id(F.col("v"))) == [
        "abcDEF12_-x", "abcDEF12_-x", "9zyXWV87_-q", "short", "a/"
    ]
    assert one(["x"], videos.watch_url(F.col("v"))) == ["https://www.youtube.com/watch?v=x"]


def test_title(one):
    titles = ['  a<b>:"/\\|?*c ', "x" * 120, '???', "", None, "ação\nlinha"]
    assert one(titles, videos.clean_title(F.col("v"), F.lit("id"))) == [
        "abc", "x" * 100, "id", "id", "id", "ação\nlinha"
    ]


@pytest.fixture
def listing(spark):
    rows = [
        ("a", "videos", 1, "v1"), ("a", "videos", 2, " "), ("a", "videos", 3, " v2 "),
        ("a", "shorts", 1, "v2"), ("a", "shorts", 2, "s1"),
        ("b", "shorts", 1, "s2"), ("b", "shorts", 2, "s2"), ("b", "live", 0, "l"),
        ("c", "videos", 1, ""), ("c", "videos", 2, "v9"), ("c", "videos", 3, "v8"),
        ("c", "videos", 4, "v7"),
    ]
    return spark.createDataFrame(rows, "channel string, kind string, pos int, video_id string")


def ids(frame):
    out = {}
    for row in frame.orderBy("channel", "place").collect():
        out.setdefault(row.channel, []).append(row.video_id)
    return out


def test_kind_policy(listing):
    assert ids(lists.channel_links(listing, "videos", 2)) == {
        "a": ["v1", "v2"], "b": ["s2", "s2"], "c": ["v9", "v8"]
    }
    assert ids(lists.channel_links(listing, "shorts", 5)) == {"a": ["v2", "s1"], "b": ["s2", "s2"]}
    both = lists.channel_links(listing, "both", 3)
    assert ids(both) == {"a": ["v1", "v2", "s1"], "b": ["s2"], "c": ["v9", "v8", "v7"]}
    assert both.first().url.startswith("https://www.youtube.com/watch?v=")
    with pytest.raises(ValueError):
        lists.channel_links(listing, "all", 3)


def test_totals(listing):
    totals = {r.channel: r.links for r in lists.link_totals(lists.channel_links(listing, "both", 3)).collect()}
    assert totals == {"a": 3, "b": 1, "c": 3, None: 7}


def test_rejected(spark):
    links = spark.createDataFrame([("a",), ("b",), ("c",)], "video_id string")
    spoken = spark.createDataFrame([("a",), ("a",)], "video_id string")
    known = spark.createDataFrame([("b", "disabled"), ("a", "x")], "video_id string, reason string")
    found = lists.rejected_videos(links, spoken, known)
    assert sorted((r.video_id, r.reason) for r in found.collect()) == [
        ("b", "disabled"), ("c", "no-transcript")
    ]
    assert lists.rejected_videos(links, spoken).count() == 2


@pytest.fixture
def segments(spark):
    rows = [("a", "pt-BR", 0, "x"), ("a", "pt-BR", 1, "y"), ("b", "pt-BR", 0, "no"),
            ("b", "pt", 1, "2"), ("b", "pt", 0, "1"), ("b", "pt", 10, "3"), ("c", "en", 0, "z")]
    return spark.createDataFrame(rows, "video_id string, language string, seg_no int, text string")


def test_language_and_text(segments):
    texts = transcripts.segments_to_text(transcripts.preferred_language(segments))
    assert sorted(map(tuple, texts.collect())) == [("a", "x\ny"), ("b", "1\n2\n3")]


def test_a_long_transcript_is_one_text(spark):
    rows = spark.range(50_000, 110_003).selectExpr(
        "'v' AS video_id", "CAST(id AS int) AS seg_no", "CAST(id AS string) AS text"
    )
    found = transcripts.segments_to_text(rows.repartition(5)).collect()
    assert [r.text for r in found] == ["\n".join(map(str, range(50_000, 110_003)))]


def test_last_title_wins(spark):
    rows = [("t", 1, "a"), ("t", 3, "b"), ("u", 2, "c")]
    titles = spark.createDataFrame(rows, "title string, pos int, video_id string")
    assert sorted(r.video_id for r in transcripts.latest_per_title(titles).collect()) == ["b", "c"]
    assert [r.video_id for r in transcripts.replaced_titles(titles).collect()] == ["a"]
