"""The test tables in the shapes the operators read."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.language import LanguageRule
from newsloom.functions.times import instant, slot_stamp, slot_start
from newsloom.session import utc_session
from newsloom.sources.package_source import FORMAT as PACKAGES
from newsloom.sources.package_source import use_packages
from newsloom.sources.packages import FILE_SCHEMA

# A rule with hints that occur in the page addresses of the test tables.
SPANISH = LanguageRule(
    code="SPA",
    suffixes=(".org",),
    hosts=("blog.ththan.example.net", "m.therou.example.com", "example.com"),
    sections=("example.net/es", "example.com/es"),
    query_keys=("utm_source", "ref"),
    query_value=r"(?U)\b(?:feed|x)\b",
)


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A test table. ``spread`` is for work that is heavy per row: the one local file
    of a small table is one task's work otherwise. A folder of files is left alone."""
    path = f"{sf_dir}/{name}.parquet"
    rows = utc_session(spark).read.parquet(path)
    if spread and os.path.isfile(path):
        return rows.repartition(spark.sparkContext.defaultParallelism)
    return rows


def by_value(value: Column, cases: dict[str, str], other: str = "") -> Column:
    """A text chosen by the value of a column."""
    out = F.lit(other)
    for key, text in cases.items():
        out = F.when(value == key, text).otherwise(out)
    return out


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a feed row. Addresses repeat, and many are empty."""
    events = table(spark, sf_dir, "events", spread=True)
    kind, value = F.col("event_type"), F.col("value")
    host = by_value(
        kind,
        {
            "view": "g1.globo.com",
            "click": "www.example.com",
            "purchase": "News.Example.com.br:8080",
            "signup": "www.bbc.com/portuguese",
        },
        "paper.example.org",
    )
    query = F.when(value > 20, "?hl=pt-BR").when(value > 10, "?lang=en&hl=").otherwise("")
    url = F.concat(F.lit("https://"), host, F.lit("/"), F.col("user_id").cast("string"), query)
    ts = instant(F.col("ts"))
    return events.select(
        slot_stamp(slot_start(ts)).alias("slot"),
        F.col("event_id").alias("row_no"),
        F.date_format(ts, "yyyyMMddHHmmss").alias("date"),
        kind.alias("source"),
        F.when((kind == "error") & (value >= 30), "").otherwise(url).alias("url"),
        F.concat(F.lit("TAX_"), F.upper(kind)).alias("themes"),
        F.when(value < 5, "1#Brazil#BR#")
        .when(value < 15, "4#Recife#BRA#")
        .when(value < 25, "1#Brasil#BRA_1#")
        .otherwise("")
        .alias("locations"),
        value.cast("string").alias("tone"),
        F.when((kind == "click") & (value < 8), "srclc:por;eng:GT-POR 1.0")
        .when(kind == "click", "srclc:spa;eng:GT-SPA 1.0")
        .otherwise("")
        .alias("translation"),
        F.date_trunc("second", ts).alias("date_utc"),
    )


def page_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages dated by the event of the same number; some addresses lead nowhere."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("page_id"), "event_type", instant(F.col("ts")).alias("date_utc")
    )
    gone = F.when(F.col("event_type") == "error", "?gone").otherwise("")
    return pages.join(events, "page_id").select(
        "page_id", F.concat("url", gone).alias("url"), "date_utc"
    )


_PACKED = ["date", "source", "url", "themes", "locations", "tone", "translation"]


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One zip per Arrow batch: 26 tab-separated cells per line."""
    places = [1, 3, 4, 8, 10, 15, 25]
    for batch in batches:
        if batch.empty:
            continue
        lines = []
        for row_no, row in zip(batch["row_no"], batch[_PACKED].itertuples(index=False)):
            cells = [str(row_no)] + [""] * 25
            for place, cell in zip(places, row):
                cells[place] = cell
            lines.append("\t".join(cells))
        body = io.BytesIO()
        stamp = batch["slot"].iloc[0]
        with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr(f"{stamp}.gkg.csv", "\n".join(lines) + "\n")
        content = body.getvalue()
        yield pd.DataFrame(
            {
                "path": [f"{stamp}.gkg.csv.zip"],
                "modificationTime": [pd.Timestamp(0, tz="UTC")],
                "length": [len(content)],
                "content": [content],
            }
        )


def packed_feed(feed: DataFrame) -> DataFrame:
    """The feed as rows of a binary file table, packages of bounded size."""
    return feed.select("slot", "row_no", *_PACKED).mapInPandas(_pack, FILE_SCHEMA)


# Landed packages: their hours, kinds by hour, the values from which a line is too long and up to
# which it is short, and what stands around a quoted source.
PACKAGE_HOURS = 6
WIDTHS = {0: 27, 1: 26, 2: 10, 3: 8}
LONG_FROM, SHORT_UP_TO = 60, 2
QUOTED = ('"<', '>\t""x"""')


def _kind(slot: Column) -> Column:
    return F.floor(F.substring(slot, 9, 2).cast("int") / PACKAGE_HOURS) % len(WIDTHS)


def package_text(feed: DataFrame) -> DataFrame:
    """The feed as lines ``(slot, row_no, line)`` of packages of some hours: wide and narrow ones, with
    lines too long and short, and quoted cells that hold a tab and a quote."""
    first = F.floor(F.substring("date", 9, 2).cast("int") / PACKAGE_HOURS) * PACKAGE_HOURS
    slot = F.concat(F.substring("date", 1, 8), F.lpad(first.cast("string"), 2, "0"), F.lit("0000"))
    kind = _kind(slot)
    source = F.when(
        F.col("source") == "signup", F.concat(F.lit(QUOTED[0]), "source", F.lit(QUOTED[1]))
    ).otherwise(F.col("source"))
    at = {1: F.col("date"), 3: source, 4: F.col("url"), 8: F.col("themes"), 10: F.col("locations"),
          15: F.col("tone"), 25: F.col("translation")}
    narrow = {10: {**at, 9: at[10]}, 8: {**at, 7: at[8]}}

    def line(width: int) -> Column:
        places = narrow.get(width, at)
        cells = [F.col("row_no").cast("string"), *(places.get(p, F.lit("")) for p in range(1, width))]
        short = F.array_join(F.array(*cells[:5]), "\t")
        whole = F.array_join(F.array(*cells), "\t")
        return F.when(F.col("_value") < SHORT_UP_TO, short).otherwise(whole)

    text = F.lit(None).cast("string")
    for k, width in WIDTHS.items():
        text = F.when(kind == k, line(width)).otherwise(text)
    more = F.when(F.col("_value") >= LONG_FROM, "\tmore").otherwise("")
    return feed.withColumn("_value", F.col("tone").cast("double")).select(
        slot.alias("slot"),
        "row_no",
        F.concat(text, more).alias("line"),
    )


def with_heads(lines: DataFrame) -> DataFrame:
    """A first line of the right width in front of each package, as the others vary."""
    kind = _kind(F.col("slot"))
    width = F.lit(0)
    for k, cells in WIDTHS.items():
        width = F.when(kind == k, cells).otherwise(width)
    heads = lines.groupBy("slot").agg(F.min("row_no").alias("least")).select(
        "slot", F.lit(-1).cast("bigint").alias("row_no"), F.concat(F.lit("head"), F.repeat(F.lit("\t"), width - 1)).alias("line")
    )
    return heads.union(lines)


# Drops of packages: days in order, but for some that come one drop later.
DROPS = 3
DROP_DELAY = "3 days"


def drop_of(slot: Column) -> Column:
    day, hour = (F.substring(slot, at, 2).cast("int") for at in (7, 9))
    delayed = ((day == 5) & (hour < 12)) | ((day == 10) & (hour % 12 == 6))
    return F.when((day <= 10) & ~delayed, 0).when((day <= 20) & ~((day == 20) & (hour % 12 == 6)), 1).otherwise(2)


def landed_packages(
    spark: SparkSession, sf_dir: str, folder: str, condition: Column | None = None
) -> str:
    """The feed as zip files below ``folder``; ``condition`` picks packages."""
    lines = with_heads(package_text(event_feed(spark, sf_dir)))
    if condition is not None:
        lines = lines.where(condition)
    use_packages(spark)
    n = spark.sparkContext.defaultParallelism
    ordered = lines.repartition(n, "slot").sortWithinPartitions("slot", "row_no")
    ordered.write.format(PACKAGES).mode("append").save(folder)
    return folder


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as corpora by source."""
    return table(spark, sf_dir, "documents", spread=True).select(
        F.col("source").alias("corpus_key"),
        F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("file_name"),
        "text",
    )


def turn_analyses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as responses with all nine lists, made of a turn's words. One
    corpus per role."""
    turns = table(spark, sf_dir, "conversations", spread=True)
    said = F.split("text", r"\s+")
    first, last = F.get(said, F.lit(0)), F.element_at(said, -1)

    def start(n: int) -> Column:
        return F.concat_ws(" ", F.slice(said, 1, n))

    def of(test: Callable[[Column], Column], **parts: Callable[[Column], Column]) -> Column:
        shape = lambda w: F.struct(*[make(w).alias(name) for name, make in parts.items()])
        return F.transform(F.filter(said, test), shape)

    word = lambda w: w
    response = F.struct(
        F.col("role").alias("tom"),
        F.array(
            F.struct(first.alias("formato"), last.alias("exemplo"), F.slice(said, 1, 2).alias("marcadores_lexicais"))
        ).alias("estruturas_piada"),
        of(
            lambda w: F.endswith(w, F.lit(",")), tipo=word, intensidade=lambda w: F.lit("alta"), exemplo=lambda w: first
        ).alias("gatilhos_comicos"),
        F.array(F.struct(start(2).alias("molde"), F.lit("abertura").alias("uso"))).alias("moldes_frasais"),
        of(lambda w: F.length(w) >= 10, texto=word, exemplo=lambda w: last).alias("vicios_expressao"),
        of(lambda w: F.lit(True), texto=word).alias("marcadores_discurso"),
        of(lambda w: F.length(w) == 3, texto=word, exemplo=lambda w: first).alias("bordoes"),
        of(lambda w: F.length(w) <= 2, texto=word).alias("interjeicoes"),
        of(lambda w: F.endswith(w, F.lit(".")), tema=word).alias("temas_recorrentes"),
        F.array(start(3)).alias("exemplos_representativos"),
    )
    return turns.select(
        F.col("role").alias("corpus_key"),
        (F.col("conv_id") * 100 + F.col("turn")).alias("block_no"),
        F.to_json(response).alias("response"),
    )


def document_analyses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as analyses with scalars only. One corpus per source."""
    docs = table(spark, sf_dir, "documents")
    size = F.col("n_chars")
    analysis = F.struct(
        F.col("lang").alias("tom"),
        F.when(size > 2000, "longo").when(size > 500, "medio").alias("humor"),
        F.when(size % 2 == 0, "par").otherwise("impar").alias("ritmo"),
        F.lit("misto").alias("ritmo_comico"),
        F.struct(
            F.when(size > 1000, "alta").otherwise("baixa").alias("caixa_alta"),
            F.lit(None).cast("string").alias("pausas_elongadas"),
        ).alias("pontuacoes_enfase"),
        ((size % 8) / 8.0).alias("confianca_global"),
    )
    return docs.select(
        F.col("source").alias("corpus_key"), F.col("doc_id").alias("block_no"),
        analysis.alias("analysis"),
    )


def channel_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Listings of channels (one per user), and videos that are conversations with titles from documents."""
    events = table(spark, sf_dir, "events")
    kinds = {"view": "videos", "click": "videos", "purchase": "shorts", "signup": "shorts"}
    number = lambda column: F.lpad(column.cast("string"), 11, "v")
    turns = table(spark, sf_dir, "conversations")
    docs = table(spark, sf_dir, "documents")
    return {
        "channels": events.select(
            F.concat(F.lit("https://www.youtube.com/@c"), F.col("user_id").cast("string"), F.lit("/videos")).alias(
                "channel_url"
            )
        ).distinct(),
        "listing": events.select(
            F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("channel"),
            by_value(F.col("event_type"), kinds, "live").alias("kind"),
            F.col("event_id").alias("pos"),
            number(F.floor("value")).alias("video_id"),
        ),
        "segments": turns.select(
            number(F.col("conv_id")).alias("video_id"), F.lit("pt").alias("language"), F.col("turn").alias("seg_no"), "text"
        ),
        "titles": docs.select(
            number(F.col("doc_id")).alias("video_id"), F.col("source").alias("title")
        ),
    }
