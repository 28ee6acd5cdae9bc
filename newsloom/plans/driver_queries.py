"""The driver's queries: every operator over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.fixed_values import FIELD_POSITIONS
from newsloom.functions import pages as page_functions
from newsloom.functions import prompts as prompt_functions
from newsloom.functions import cleaning, language, style, times, urls, videos
from newsloom.functions.language import in_brazil, source_language
from newsloom.operators import (
    articles,
    corpus,
    feed,
    fusion,
    lexical,
    responses,
    slots,
    transcripts,
)
from newsloom.operators import videos as video_operators
from newsloom.plans.driver_inputs import (
    DROP_DELAY,
    DROPS,
    PACKAGE_HOURS,
    SPANISH,
    by_value,
    channel_tables,
    document_analyses,
    document_texts,
    drop_of,
    event_feed,
    landed_packages,
    packed_feed,
    page_feed,
    table,
    turn_analyses,
)
from newsloom.plans import jobs
from newsloom.session import scratch_path, stored
from newsloom.sources import landing, package_source, packages, page_store, sinks, texts
from newsloom.sources.keyed_table import KeyedTable
from newsloom.streaming import feed_stream

ZONE = "America/Boa_Vista"
HALF_HOUR_ZONE = "America/St_Johns"
AS_OF = datetime(2024, 1, 15, 16, 0, tzinfo=timezone.utc)
TOP = 200
FEED_FIELDS = ["url", "source", "slot", "row_no", "date_local_iso", "date_utc_iso"]
CATCHPHRASES = ["que les", "of the", "de la", "und der"]
AVOIDED = ["tion on", "eau les", "ción", "ung"]
NEGATIVES = ["de la", "OF THE", "eau.", "und"]
INSERTED = ["né, cara?", "escuta!", "sabe?"]
PROMPT = (
    "Idioma {{idioma|pt-BR}}, até {{max_itens|10}} itens, {{nada}}{{falta|sem nota}}.\n"
    "Trecho $$ ${max_itens}:\n{{trecho}}\nFim ${outro}"
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# ---- slots and time -------------------------------------------------------


@query
def slot_floor_counts(spark, sf_dir):
    return slots.slot_counts(table(spark, sf_dir, "events"), "ts")


def _manifest(spark, sf_dir, window_minutes=0):
    return slots.daily_manifest(table(spark, sf_dir, "events"), "ts", ZONE, window_minutes)


def _day_text(name: str = "local_day") -> Column:
    return F.date_format(name, "yyyy-MM-dd").alias(name)


@query
def slot_manifest(spark, sf_dir):
    return _manifest(spark, sf_dir).select(_day_text(), "slot", "package")


@query
def slot_manifest_window(spark, sf_dir):
    return _manifest(spark, sf_dir, 120).select(_day_text(), "slot", "package")


def _arrived(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(times.slot_stamp(times.slot_start(F.col("ts"))).alias("slot"))


@query
def slot_missing(spark, sf_dir):
    missing = slots.missing_slots(_manifest(spark, sf_dir), _arrived(spark, sf_dir))
    return missing.select(_day_text(), "slot")


@query
def slot_arrivals(spark, sf_dir):
    counts = slots.arrival_counts(
        _manifest(spark, sf_dir), _arrived(spark, sf_dir), "local_day"
    )
    return counts.select(_day_text(), "ok", "missing")


@query
def stamp_parse(spark, sf_dir):
    stamp = F.date_format("ts", times.STAMP)
    broken = (
        F.when(F.col("event_type") == "error", F.substring(stamp, 1, 8))
        .when(F.col("event_type") == "signup", F.concat(F.lit("x"), F.substring(stamp, 2, 13)))
        .otherwise(stamp)
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        broken.alias("stamp"),
        F.unix_seconds(times.parse_stamp(broken)).alias("seconds"),
    )


def _event_times(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", times.instant(F.col("ts")).alias("date_utc")
    )


def _dates(rows: DataFrame, zone: str) -> DataFrame:
    return feed.with_dates(rows, zone).select(
        "event_id",
        F.date_format("date_local", times.WALL).alias("date_local"),
        "date_local_iso",
        "date_utc_iso",
        _day_text(),
    )


@query
def local_day_rows(spark, sf_dir):
    return _dates(feed.today(_event_times(spark, sf_dir), AS_OF, ZONE), ZONE)


@query
def local_wall_clock(spark, sf_dir):
    return _dates(_event_times(spark, sf_dir), HALF_HOUR_ZONE)


# ---- addresses, language and place ------------------------------------------


def _page_parts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", urls.url_parts(urls.url_pieces(F.col("url"))).alias("parts")
    )


@query
def url_parts(spark, sf_dir):
    pairs = F.transform("parts.query", lambda q: F.concat(q["key"], F.lit("="), q["value"]))
    return _page_parts(spark, sf_dir).select(
        "page_id", "parts.host", "parts.path", F.array_join(pairs, "&").alias("query")
    )


def _masked(test: Callable[[Column], Column], name: str) -> Query:
    def run(spark, sf_dir):
        return _page_parts(spark, sf_dir).select("page_id", test(F.col("parts")).alias("hit"))

    run.__name__ = name
    return query(run)


host_mask = _masked(SPANISH.host_hit, "host_mask")
query_mask = _masked(SPANISH.query_hit, "query_mask")
section_mask = _masked(SPANISH.section_hit, "section_mask")


@query
def url_mask(spark, sf_dir):
    hit = language.url_mask(F.col("url"), (SPANISH,))
    return table(spark, sf_dir, "pages").select("page_id", hit.alias("hit"))


@query
def source_code(spark, sf_dir):
    codes = {"en": "eng", "fr": "fra", "de": "deu", "es": "spa"}
    note = F.concat(F.lit("x;SRCLC: "), by_value(F.col("lang"), codes), F.lit(";eng:GT 1.0"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", source_language(note).alias("code")
    )


@query
def language_filter(spark, sf_dir):
    rows = feed.in_languages(event_feed(spark, sf_dir), frozenset({"POR"}))
    return rows.select("row_no", "url", "translation")


@query
def language_filter_by_rule(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").withColumn("translation", F.lit(""))
    kept = feed.in_languages(rows, frozenset({"SPA", "ENG"}), (SPANISH,))
    return kept.select("page_id", "url")


@query
def place_filter(spark, sf_dir):
    places = {"NATION_1": "1#Brazil#BR#", "NATION_2": "4#Recife#BRA#", "NATION_3": "x#BRA_1#"}
    nations = table(spark, sf_dir, "nation").select(
        "n_nationkey", "n_name", by_value(F.col("n_name"), places, "none").alias("locations")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    rows = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.filter(in_brazil(F.col("locations"))).select("c_custkey", "n_name", "locations")


# ---- feed ---------------------------------------------------------------------


@query
def first_per_key(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return feed.first_per_key(docs, ["text"], ["doc_id"]).select(
        "doc_id", "source", "lang", "n_chars"
    )


@query
def news_newest(spark, sf_dir):
    rows = feed.in_languages(event_feed(spark, sf_dir), frozenset({"POR"}))
    news = feed.with_dates(feed.one_per_url(rows), ZONE)
    return feed.newest_first(news).select(*FEED_FIELDS)


@query
def news_daily(spark, sf_dir):
    news = feed.daily_news(event_feed(spark, sf_dir), AS_OF, ZONE, brazil=True)
    return feed.newest_first(news).select(*FEED_FIELDS)


@query
def news_top(spark, sf_dir):
    rows = feed.one_per_url(event_feed(spark, sf_dir))
    return feed.newest(feed.with_dates(rows, ZONE), TOP).select(*FEED_FIELDS)


@query
def filter_funnel(spark, sf_dir):
    rows = event_feed(spark, sf_dir)
    in_day = times.within_local_day(F.col("date_utc"), AS_OF, ZONE)
    return feed.funnel(rows, in_day, brazil=True)


@query
def funnel_observed(spark, sf_dir):
    """The same counts as metrics of the write, without a pass of their own."""
    rows = event_feed(spark, sf_dir)
    in_day = times.within_local_day(F.col("date_utc"), AS_OF, ZONE)
    counted = feed.CountedNews(rows, in_day, ZONE, brazil=True)
    sinks.write_feed(stored(counted.news, "news"), scratch_path(spark, "observed"))
    return counted.funnel(spark)


@query
def filter_funnel_by_day(spark, sf_dir):
    rows = event_feed(spark, sf_dir).withColumn(
        "local_day", times.local_day(F.col("date_utc"), ZONE)
    )
    counts = feed.funnel(rows, F.lit(True), by=("local_day",))
    return counts.select(
        _day_text(), "rows_read", "url_hits", "translation_hits", "after_language", "after_dedup"
    )


# ---- articles -------------------------------------------------------------------


@query
def page_title_lang(spark, sf_dir):
    return table(spark, sf_dir, "pages", spread=True).select(
        "page_id",
        page_functions.page_title(F.col("html")).alias("title"),
        page_functions.page_language(F.col("html")).alias("lang"),
    )


@query
def page_text(spark, sf_dir):
    return table(spark, sf_dir, "pages", spread=True).select(
        "page_id", page_functions.page_text(F.col("html")).alias("text")
    )


@query
def page_status(spark, sf_dir):
    pages = articles.page_articles(table(spark, sf_dir, "pages", spread=True), min_chars=1000)
    return pages.select("page_id", "fetch_status")


@query
def enrich_top_n(spark, sf_dir):
    rows = articles.enrich_newest(
        page_feed(spark, sf_dir), table(spark, sf_dir, "pages"), TOP
    )
    return rows.select(
        "page_id",
        "url",
        times.iso_utc(F.col("date_utc")).alias("date_utc_iso"),
        "title",
        "text",
        "lang",
        "fetch_status",
    )


@query
def enrich_from_store(spark, sf_dir):
    """The same from a page store, of which only the wanted buckets and rows are read."""
    path = scratch_path(spark, "pages")
    page_store.write_pages(table(spark, sf_dir, "pages", spread=True), path, 16)
    news = stored(page_feed(spark, sf_dir), "news")
    rows = articles.enrich_from_store(news, page_store.PageStore(spark, path, 16), TOP)
    return rows.select(
        "page_id", "url", times.iso_utc(F.col("date_utc")).alias("date_utc_iso"), "title", "text", "lang", "fetch_status"
    )


# ---- videos and transcripts -------------------------------------------------------


@query
def handle_extract(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    place = F.split_part("url", F.lit("/"), F.lit(3))
    address = F.when(
        F.startswith("url", F.lit("https")),
        F.concat(F.lit("https://www.youtube.com/@"), place, F.lit("/videos")),
    ).otherwise(F.concat(F.lit("https://www.youtube.com/c/"), place))
    return pages.select("page_id", videos.channel_handle(address).alias("handle"))


@query
def tab_url(spark, sf_dir):
    url = F.concat(F.lit("https://www.youtube.com/@"), F.split_part("url", F.lit("/"), F.lit(4)),
                   F.when(F.col("page_id") % 2 == 0, "/videos/").otherwise("//"))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        videos.tab_url(url, "videos").alias("videos"),
        videos.tab_url(url, "shorts").alias("shorts"),
    )


def _event_video() -> Column:
    return F.lpad(F.col("event_id").cast("string"), 11, "v")


@query
def watch_url(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", videos.watch_url(_event_video()).alias("url")
    )


@query
def video_id(spark, sf_dir):
    url = F.when(
        F.col("event_type") == "view",
        F.concat(videos.watch_url(_event_video()), F.lit("&t=10s")),
    ).otherwise(F.concat(F.lit("https://youtu.be/"), _event_video()))
    return table(spark, sf_dir, "events").select("event_id", videos.video_id(url).alias("video"))


def _listing(spark, sf_dir, daily: bool = False):
    user = F.concat(F.lit("c"), F.col("user_id").cast("string"))
    day = F.date_format("ts", "-yyyyMMdd")
    kinds = {"view": "videos", "click": "videos", "purchase": "shorts", "signup": "shorts"}
    return table(spark, sf_dir, "events").select(
        (F.concat(user, day) if daily else user).alias("channel"),
        by_value(F.col("event_type"), kinds, "live").alias("kind"),
        F.col("event_id").alias("pos"),
        F.when(F.col("value") < 1, " ")
        .otherwise(F.concat(F.lit(" v"), F.floor("value").cast("string")))
        .alias("video_id"),
    )


@query
def tab_listing(spark, sf_dir):
    return video_operators.listed_ids(_listing(spark, sf_dir), 5)


@query
def kind_union_limit(spark, sf_dir):
    return video_operators.channel_links(_listing(spark, sf_dir), "both", 3)


@query
def kind_videos(spark, sf_dir):
    """One channel per user and day, so that many have shorts only."""
    return video_operators.channel_links(_listing(spark, sf_dir, daily=True), "videos", 2)


@query
def title_clean(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        videos.clean_title(F.col("text"), F.col("doc_id").cast("string")).alias("title"),
    )


def _titles(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        videos.clean_title(F.col("text"), F.col("doc_id").cast("string")).alias("title"),
        F.col("doc_id").alias("pos"),
        F.col("doc_id").cast("string").alias("video_id"),
    )


@query
def title_last_wins(spark, sf_dir):
    return transcripts.latest_per_title(_titles(spark, sf_dir))


@query
def title_replaced(spark, sf_dir):
    return transcripts.replaced_titles(_titles(spark, sf_dir)).select("title", "pos", "video_id")


@query
def segments_to_text(spark, sf_dir):
    segments = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("video_id"), (F.col("turn") + 50_000).alias("seg_no"), "text"
    )
    return transcripts.segments_to_text(segments)


@query
def prefer_language(spark, sf_dir):
    segments = table(spark, sf_dir, "documents").select(
        F.floor(F.col("doc_id") / 4).alias("video_id"),
        F.col("lang").alias("language"),
        F.col("doc_id").alias("seg_no"),
    )
    return transcripts.preferred_language(segments, ["es", "fr"])


@query
def links_rollup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("channel"))
    return video_operators.link_totals(docs)


@query
def links_rejected(spark, sf_dir):
    links = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("video_id"), "source")
    labels = table(spark, sf_dir, "labels")
    spoken = labels.filter(F.col("toxic") == 0).select(F.col("doc_id").alias("video_id"))
    known = labels.filter(F.col("toxic") == 1).select(
        F.col("doc_id").alias("video_id"), F.lit("disabled").alias("reason")
    )
    return video_operators.rejected_videos(links, spoken, known)


# ---- cleaning, corpora, blocks -------------------------------------------------------


@query
def clean_text(spark, sf_dir):
    marked = F.concat(
        F.lit("0:15 oi 1:02:03 [MÚSICA alta]  \t"),
        F.col("text"),
        F.lit("\n[ __ ] [risos] 12:345 [Aplausos\n] 9:59"),
    )
    return table(spark, sf_dir, "documents", spread=True).select("doc_id", cleaning.clean_text(marked).alias("text"))


@query
def corpus_by_source(spark, sf_dir):
    return corpus.corpus_lines(document_texts(spark, sf_dir))


@query
def blocks(spark, sf_dir):
    return corpus.blocks(document_texts(spark, sf_dir), 1500)


@query
def blocks_clean_first(spark, sf_dir):
    return corpus.blocks(document_texts(spark, sf_dir), 4000, clean_first=True)


# ---- prompts, responses, style books -----------------------------------------------------


@query
def prompts(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("corpus_key"), F.col("turn").alias("block_no"), "text"
    )
    return responses.prompts(turns, PROMPT, max_items=15)


@query
def responses_parsed(spark, sf_dir):
    kind, props = F.col("event_type"), F.col("props")
    response = (
        F.when(kind == "view", props)
        .when(kind == "click", F.concat(F.lit("```json\n"), props, F.lit("\n```")))
        .when(kind == "purchase", F.concat(F.lit("sure: "), props))
        .when(kind == "signup", F.concat(F.lit("["), props, F.lit("]")))
    )
    rows = table(spark, sf_dir, "events").select("event_id", response.alias("response"))
    return responses.parsed(rows, "struct<k:int>").select(
        "event_id",
        F.col("analysis.k").alias("k"),
        F.col("error.kind").alias("kind"),
        F.col("error.sample").alias("sample"),
    )


@query
def analysis_table(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("corpus_key"), F.col("turn").alias("block_no"), "role", "text"
    )
    answered = turns.filter(F.col("role") == "assistant").select(
        "corpus_key", "block_no", F.to_json(F.struct(F.col("text").alias("tom"))).alias("response")
    )
    return responses.analyses(turns, answered).select(
        "corpus_key",
        "block_no",
        F.col("analysis.tom").alias("tom"),
        F.col("error.kind").alias("kind"),
    )


def _item_form() -> Column:
    marks = F.array_join("item.marcadores_lexicais", "+")
    return F.concat_ws("|", *[f"item.{part}" for part in fusion.ITEM_PARTS], marks)


@query
def fuse_items(spark, sf_dir):
    """All nine lists; keys are ranked, and the winners' items fetched."""
    ranked = fusion.ranked_items(_stored_analyses(turn_analyses(spark, sf_dir)))
    return ranked.select("corpus_key", "list", "place", "key", "recurrence", _item_form().alias("form"))


@query
def fuse_scalars(spark, sf_dir):
    return fusion.fused_scalars(document_analyses(spark, sf_dir)).drop("blocks")


def _stored_analyses(answered: DataFrame) -> DataFrame:
    """Parsed once, as the style job does."""
    return stored(responses.parsed(answered).drop("response"), "analyses")


def _weighted(name: str) -> Column:
    """A list of the book as text, each item with its weight in millionths."""
    if name == "exemplos_representativos":
        return F.array_join(F.col(f"book.{name}"), ";").alias(name)

    def form(item: Column) -> Column:
        parts = [F.array_join(item[p], "+") if p == "marcadores_lexicais" else item[p] for p in fusion.LIST_PARTS[name]]
        said = F.concat_ws("|", *parts)
        if name in fusion.UNWEIGHTED:
            return said
        return F.concat(said, F.lit(":"), F.round(item["peso"] * 1_000_000).cast("bigint").cast("string"))

    return F.array_join(F.transform(F.col(f"book.{name}"), form), ";").alias(name)


@query
def style_books(spark, sf_dir):
    """Books in full: every list with its weights."""
    analysed = _stored_analyses(turn_analyses(spark, sf_dir))
    books = fusion.style_books(analysed, AS_OF)
    return books.select(
        "corpus_key",
        F.col("book.tom").alias("tom"),
        *[_weighted(name) for name in fusion.LIST_KEYS],
        F.col("book.observacoes").alias("observacoes"),
        F.col("book.versao").alias("versao"),
        F.col("book.gerado_em").alias("gerado_em"),
        F.col("book._fonte").alias("fonte"),
    )


@query
def style_context(spark, sf_dir):
    """The six lists and the scalars that go into prompts."""
    analysed = _stored_analyses(turn_analyses(spark, sf_dir))
    books = fusion.style_books(analysed, AS_OF, max_items=40)
    context = books.select("corpus_key", style.style_context(F.col("book")).alias("c"))
    lists = ["moldes_de_piada", "estruturas_piada", "gatilhos_comicos", "marcadores", "bordoes", "interjeicoes"]
    return context.select(
        "corpus_key",
        *[f"c.{name}" for name in ("tom", "humor", "ritmo", "ritmo_comico", "pausas")],
        *[F.array_join(F.col(f"c.{name}"), ";").alias(name) for name in lists],
    )


@query
def books_failed(spark, sf_dir):
    """A corpus none of whose blocks can be read keeps a record of the failed merge."""
    answered = turn_analyses(spark, sf_dir)
    broken = F.when(F.col("corpus_key") == "user", F.concat("response", F.lit(" and more"))).otherwise(
        F.col("response")
    )
    books = fusion.style_books(_stored_analyses(answered.withColumn("response", broken)), AS_OF)
    return books.select(
        "corpus_key",
        F.col("book.tom").alias("tom"),
        F.col("error._mensagem").alias("message"),
        F.get_json_object(fusion.book_document(), "$._erro_fusao").alias("failed"),
        F.get_json_object(fusion.book_document(), "$.versao").alias("versao"),
        F.get_json_object(fusion.book_document(), "$.gerado_em").alias("gerado_em"),
    )


@query
def books_stamped(spark, sf_dir):
    """Books from elsewhere: the date is set, version and origin only where they are missing."""
    given = F.to_json(
        F.struct(
            F.col("lang").alias("tom"),
            F.when(F.col("doc_id") % 2 == 0, "1.0").alias("versao"),
            F.when(F.col("doc_id") % 3 == 0, F.col("source")).alias("_fonte"),
            F.lit("2020-01-01").alias("gerado_em"),
        )
    )
    books = table(spark, sf_dir, "documents").select(
        "doc_id", F.from_json(given, responses.BOOK_TYPE).alias("book")
    )
    return fusion.stamped(books, AS_OF).select(
        "doc_id", "book.tom", "book.versao", F.col("book._fonte").alias("fonte"), "book.gerado_em"
    )


@query
def style_score(spark, sf_dir):
    phrases = F.array(*[F.lit(p) for p in CATCHPHRASES])
    avoided = F.array(*[F.lit(w) for w in AVOIDED])
    return table(spark, sf_dir, "documents", spread=True).select(
        "doc_id",
        style.style_score(F.col("text"), phrases, avoided, F.lit(0.5), F.lit(0.25)).alias("score"),
    )


def _edited(edit: Callable[[Column], Column], name: str) -> Query:
    def run(spark, sf_dir):
        docs = table(spark, sf_dir, "documents", spread=True)
        return docs.select("doc_id", edit(F.col("text")).alias("text"))

    run.__name__ = name
    return query(run)


phrase_remove = _edited(lambda t: style.remove_phrases(t, NEGATIVES), "phrase_remove")
phrase_insert = _edited(lambda t: style.insert_phrases(t, INSERTED), "phrase_insert")
phrase_append = _edited(
    lambda t: style.insert_phrases(t, INSERTED, literal_split=True), "phrase_append"
)
punch_up = _edited(lambda t: style.punch_up(t, NEGATIVES, INSERTED), "punch_up")
outline = _edited(style.outline, "outline")


@query
def lexical_profile(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents", spread=True).select(
        "doc_id",
        F.size(lexical.words(text)).alias("n_words"),
        F.round(lexical.caps_share(text), 6).alias("caps_share"),
        lexical.level(lexical.pause_share(text)).alias("pauses"),
    )


@query
def lexical_books(spark, sf_dir):
    """Blocks, counted signals and merging, without any model."""
    turns = table(spark, sf_dir, "conversations", spread=True).select(
        F.col("role").alias("corpus_key"),
        (F.col("conv_id") * 100 + F.col("turn")).alias("block_no"),
        "text",
    )
    analysed = lexical.lexical_analyses(turns, markers=("the", "de", "la", "und", "que"))
    items = fusion.ranked_items(stored(analysed, "lexical"))
    return items.select("corpus_key", "list", "place", "key", "recurrence")


@query
def catchphrases(spark, sf_dir):
    """Runs of two to four words in three or more texts that are part of no longer one in the same texts."""
    return lexical.catchphrases(document_texts(spark, sf_dir), 3, 4, 50)


@query
def lexical_catchphrases(spark, sf_dir):
    """Books from counts alone, their catchphrases weighted by the blocks that say them."""
    turns = table(spark, sf_dir, "conversations", spread=True).select(
        F.col("role").alias("corpus_key"),
        (F.col("conv_id") * 100 + F.col("turn")).alias("block_no"),
        "text",
    )
    phrases = stored(lexical.catchphrases(turns, 3, 3), "phrases")
    analysed = lexical.lexical_analyses(turns, phrases=phrases)
    books = fusion.style_books(stored(analysed, "lexical"), AS_OF)
    said = F.transform(
        "book.bordoes",
        lambda b: F.concat(b["texto"], F.lit(":"), F.round(b["peso"] * 1_000_000).cast("bigint").cast("string")),
    )
    return books.select("corpus_key", F.array_join(F.array_sort(said), ";").alias("bordoes"))


@query
def recurrent_phrases(spark, sf_dir):
    return lexical.recurrent_phrases(document_texts(spark, sf_dir), 2, 2, 50)


# ---- packages, sinks and sources -------------------------------------------------------------


FILES_PER_TASK = 8


#: Folders of landed packages by session and tables: packages land once, queries read them.
LANDED: dict[tuple[str, str], str] = {}


def _landing(spark, sf_dir) -> str:
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in LANDED:
        LANDED[at] = landed_packages(spark, sf_dir, scratch_path(spark, "landing"))
    return LANDED[at]


def _landed_rows(spark, sf_dir):
    folder = _landing(spark, sf_dir)
    return package_source.read_rows(package_source.landed_lines(spark, folder, FILES_PER_TASK))


@query
def package_scan(spark, sf_dir):
    """Landed zips of four widths, with quoted, short and long lines."""
    return package_source.accepted(_landed_rows(spark, sf_dir)).select(
        "slot", "row_no", *FIELD_POSITIONS, F.unix_seconds("date_utc").alias("seconds")
    )


@query
def package_line_rejects(spark, sf_dir):
    """Lines with more cells than the first line of their package."""
    return package_source.line_rejects(_landed_rows(spark, sf_dir)).select(
        "slot", "row_no", "width", "n_cells", "line"
    )


def _landed_in_two_runs(spark, sf_dir):
    """Packages up to noon first, then all: the second run opens the rest only."""
    folder = _landing(spark, sf_dir)
    base = scratch_path(spark, "landed")
    every = [package_source.slot_of(p) for p in package_source.listed(folder)]
    landing.land(spark, folder, base, [s for s in every if s[8:10] < "12"], FILES_PER_TASK)
    landing.land(spark, folder, base, None, FILES_PER_TASK)
    return base


@query
def landing_ledger(spark, sf_dir):
    """What each run opened."""
    ledger = landing.opened(spark, _landed_in_two_runs(spark, sf_dir))
    return ledger.select("slot", "run", F.col("rows").alias("n_rows"), "line_rejects")


@query
def landed_day(spark, sf_dir):
    """The rows of a local day; partitions of other hours are not read."""
    base = _landed_in_two_runs(spark, sf_dir)
    start, end = times.day_bounds(AS_OF, ZONE)
    first = start.astimezone(timezone.utc).replace(hour=0)
    steps = (first + timedelta(hours=PACKAGE_HOURS * k) for k in range(8))
    due = [f"{step:%Y%m%d%H%M%S}" for step in steps if step < end]
    rows = package_source.accepted(landing.landed(spark, base, due))
    return feed.today(rows, AS_OF, ZONE).select("slot", "row_no", "url", F.unix_seconds("date_utc").alias("seconds"))


@query
def package_rejects(spark, sf_dir):
    """Every landed page taken for a package: none is a zip file."""
    pages = table(spark, sf_dir, "pages").select(
        F.format_string("20240101%06d.gkg.csv.zip", F.col("page_id")).alias("path"),
        F.encode("html", "UTF-8").alias("content"),
    )
    rejects = packages.rejected_packages(packages.read_packages(pages))
    return rejects.select("slot", F.split_part("error", F.lit(":"), F.lit(1)).alias("error"))


FEED_TEXTS = ["url", "source", "themes", "locations", "tone", "translation", "date_local_iso", "date_utc_iso"]


def _feed_sink(fmt: str) -> Query:
    """All columns of the feed; a theme holds quotes, commas and line breaks."""

    def run(spark, sf_dir):
        odd = F.concat(F.lit('"a", '), "themes", F.lit(';\n"b\\"'))
        rows = feed.one_per_url(event_feed(spark, sf_dir).withColumn("themes", odd))
        news = feed.with_dates(rows, ZONE).drop("date", "date_local")
        path = scratch_path(spark, f"feed-{fmt}")
        sinks.write_feed(news, path, fmt)
        moment = "bigint" if fmt == "json" else "timestamp"
        kinds = {"row_no": "bigint", "date_utc": moment}
        schema = ", ".join(f"{n} {kinds.get(n, 'string')}" for n in news.columns if n != "local_day")
        back = (
            spark.read.schema(schema + ", local_day date")
            .options(**({"header": "true", "multiLine": "true", "escape": '"'} if fmt == "csv" else {}))
            .format(fmt)
            .load(path)
        )
        at = F.col("date_utc") if fmt == "json" else F.unix_millis("date_utc")
        return back.select(
            "slot",
            "row_no",
            *[F.coalesce(name, F.lit("")).alias(name) for name in FEED_TEXTS],
            at.alias("millis"),
            _day_text(),
        )

    run.__name__ = f"feed_{fmt}_sink"
    return query(run)


feed_json_sink = _feed_sink("json")
feed_parquet_sink = _feed_sink("parquet")
feed_csv_sink = _feed_sink("csv")


@query
def text_sink(spark, sf_dir):
    path = scratch_path(spark, "texts")
    docs = document_texts(spark, sf_dir).select(
        F.concat("file_name", F.lit(".txt")).alias("file_name"), "text"
    )
    sinks.write_texts(transcripts.clean_texts(docs), path)
    return spark.read.parquet(path)


@query
def link_sink(spark, sf_dir):
    """Link lists written per kind in the order of channels and places, and read back with positions."""
    path = scratch_path(spark, "links")
    links = video_operators.channel_links(_listing(spark, sf_dir), "both", 3)
    ordered = links.withColumns({"kind": F.lit("both"), "pos": F.struct("channel", "place")})
    sinks.write_links(ordered, path, by=("kind",))
    back = texts.ordered_links(spark, path, "kind string")
    return back.select("kind", "pos", "url", videos.video_id(F.col("url")).alias("video"))


@query
def text_upsert(spark, sf_dir):
    """Every text first, then a fifth of them again, cleaned: only their buckets are written anew."""
    path = scratch_path(spark, "upserted")
    docs = document_texts(spark, sf_dir).select("file_name", "text")
    sinks.upsert_texts(docs, path, buckets=16)
    again = docs.where(F.col("file_name").cast("long") % 5 == 0)
    sinks.upsert_texts(transcripts.clean_texts(again), path)
    return sinks.text_table(spark, path).read()


@query
def json_upsert(spark, sf_dir):
    """JSON documents in whole, null fields kept, with those of one language put in anew."""
    path = scratch_path(spark, "documents")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    first = F.struct("lang", F.when(F.col("n_chars") > 500, F.col("n_chars")).alias("size"), F.lit("a").alias("run"))
    second = F.struct("lang", F.lit(None).cast("long").alias("size"), F.lit("b").alias("run"))
    documents = KeyedTable(spark, path, "doc_id bigint, json string", ["doc_id"], 16)
    documents.upsert(sinks.json_documents(docs, ["doc_id"], first))
    documents.upsert(sinks.json_documents(docs.where("lang = 'en'"), ["doc_id"], second))
    return documents.read()


@query
def style_book_sink(spark, sf_dir):
    """Style books as JSON documents, read back with their schema."""
    path = scratch_path(spark, "books")
    books = fusion.style_books(document_analyses_full(spark, sf_dir), AS_OF)
    sinks.write_json_documents(books, ["corpus_key"], "book", path)
    back = texts.style_books(spark, path)
    names = ["tom", "humor", "ritmo", "ritmo_comico", "observacoes", "confianca_global"]
    emphasis = [f"book.pontuacoes_enfase.{name}" for name in responses.EMPHASIS]
    return back.select("corpus_key", *[f"book.{name}" for name in names], *emphasis)


def document_analyses_full(spark, sf_dir):
    """Scalars of documents in the whole analysis shape."""
    rows = document_analyses(spark, sf_dir)
    body = F.to_json("analysis")
    return _stored_analyses(rows.withColumn("response", body).drop("analysis"))


# ---- whole chains -------------------------------------------------------------------------------


@query
def chain(spark, sf_dir):
    """Channels, links in order, transcripts by title, clean texts and blocks of every channel."""
    base = scratch_path(spark, "chain")
    given = channel_tables(spark, sf_dir)
    jobs.run_channels(**given, out=base, limit=8, max_chars=3000)
    return spark.read.parquet(f"{base}/blocks")


@query
def channel_list(spark, sf_dir):
    """A landed list of channels with comments and blank lines; without a channel the default counts."""
    path = scratch_path(spark, "channels")
    url = F.col("url")
    noted = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("# "), url)).when(
        F.col("page_id") % 7 == 0, F.lit("   ")
    )
    table(spark, sf_dir, "pages").select(F.coalesce(noted, F.concat(F.lit("  "), url, F.lit("\t")))).write.text(path)
    return texts.channel_lines(spark, path, ["https://default/"])


@query
def text_scan(spark, sf_dir):
    """Text files, one per source, read whole."""
    path = scratch_path(spark, "texts")
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", "text")
    ordered = docs.repartition("source").sortWithinPartitions("source", "doc_id")
    ordered.drop("doc_id").write.partitionBy("source").text(path)
    found = texts.text_files(spark, f"{path}/*")
    return found.select(F.md5("text").alias("digest"), F.length("text").alias("n_chars"))


@query
def language_argument(spark, sf_dir):
    """Languages named as on the command line: quotes, blanks, commas and case do not matter."""
    rows = table(spark, sf_dir, "pages").withColumn("translation", F.lit(""))
    kept = [
        feed.in_languages(rows, language.wanted_languages(given), (SPANISH,)).select(F.lit(given).alias("given"), "page_id")
        for given in ("'spa', ENG", "", '""', " , ", "Spa")
    ]
    return reduce(DataFrame.union, kept)


# ---- streams -----------------------------------------------------------------------------------


def _landed(spark, rows: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows as a landed folder read as a stream, and a folder for the run."""
    base = scratch_path(spark, name)
    rows.write.parquet(f"{base}/landed")
    return spark.readStream.schema(rows.schema).parquet(f"{base}/landed"), base


def _run(stream: DataFrame, base: str) -> DataFrame:
    feed_stream.run_available(stream, f"{base}/out", f"{base}/checkpoint")
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{base}/out")


@query
def stream_ingest(spark, sf_dir):
    files, base = _landed(spark, packed_feed(event_feed(spark, sf_dir)), "ingest")
    rows = _run(packages.feed_rows(packages.read_packages(files)), base)
    return rows.select("date", "source", "url", F.unix_seconds("date_utc").alias("seconds"))


def _dropped(spark, sf_dir, after_each=None) -> feed_stream.Ingest:
    """Packages that land in three drops, some of them late, each drop taken up by a run of its own."""
    base = scratch_path(spark, "drops")
    ingest = feed_stream.Ingest(spark, f"{base}/landing", f"{base}/packages", DROP_DELAY)
    for drop in range(DROPS):
        landed_packages(spark, sf_dir, ingest.packages, drop_of(F.col("slot")) == drop)
        ingest.run()
        if after_each is not None:
            after_each(ingest, base)
    return ingest


@query
def stream_dedup(spark, sf_dir):
    """The least row of each URL and story over three drops; late rows have no say."""

    def single(ingest: feed_stream.Ingest, base: str) -> None:
        first = feed_stream.least_arrivals(ingest.rows(), DROP_DELAY)
        feed_stream.run_available(first, f"{base}/out", f"{base}/state")
        found["rows"] = spark.read.schema(first.schema).parquet(f"{base}/out")

    found: dict[str, DataFrame] = {}
    _dropped(spark, sf_dir, single)
    return found["rows"].select("url", "slot", "row_no", "source")


@query
def stream_late(spark, sf_dir):
    """Rows that came behind the watermark."""
    late = _dropped(spark, sf_dir).of_kind(feed_stream.LATE)
    return late.select("slot", "row_no", "url", F.unix_seconds("date_utc").alias("seconds"))


@query
def stream_rejects(spark, sf_dir):
    """Lines too long, and lines without a date."""
    ingest = _dropped(spark, sf_dir)
    kinds = [ingest.of_kind(kind) for kind in (feed_stream.LINE, feed_stream.UNDATED)]
    return kinds[0].union(kinds[1]).select("kind", "slot", "row_no")


@query
def stream_slots(spark, sf_dir):
    rows, base = _landed(spark, event_feed(spark, sf_dir), "slots")
    kept = F.col("url") != ""
    return _run(feed_stream.slot_statistics(rows, kept, "30 minutes"), base)


@query
def prompt_defaults(spark, sf_dir):
    """The default templates over every turn."""
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("corpus_key"), F.col("turn").alias("block_no"), "text"
    )
    filled = responses.prompts(turns, prompt_functions.ANALYSIS_TEMPLATE)
    return filled.select("corpus_key", "block_no", F.md5("prompt").alias("digest"))
