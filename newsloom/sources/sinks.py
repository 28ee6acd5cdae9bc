"""Writers. Each writes a folder in parallel; nothing is gathered in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.feed import newest_order
from newsloom.sources.keyed_table import BUCKETS, KeyedTable

FEED_FORMATS = ("json", "parquet", "csv")


def epoch_millis(feed: DataFrame) -> DataFrame:
    """Instants as epoch milliseconds, the way the JSON lines carry them."""
    dates = [name for name in ("date_utc", "date_local") if name in feed.columns]
    return feed.withColumns({name: F.unix_millis(F.col("date_utc")) for name in dates})


def write_feed(feed: DataFrame, path: str, fmt: str = "parquet", by: str = "local_day") -> None:
    """Write a feed newest first, partitioned by local day; only the days present are replaced.

    The sort cuts by time and URL, so a file holds one or two days and a busy
    day is spread over many files. It starts with the folder column, as the
    writer would otherwise sort again.
    """
    if fmt not in FEED_FORMATS:
        raise ValueError(f"format is one of {FEED_FORMATS}")
    rows = feed.orderBy(by, *newest_order())
    writer = (epoch_millis(rows) if fmt == "json" else rows).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic")
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    if fmt == "csv":
        writer = writer.option("header", "true").option("escape", '"')
    writer.partitionBy(by).format(fmt).save(path)


def write_texts(texts: DataFrame, path: str) -> None:
    """``(file_name, text)`` rows; a text may hold line breaks, hence Parquet."""
    texts.select("file_name", "text").write.mode("overwrite").parquet(path)


TEXT_SCHEMA = "file_name string, text string"


def upsert_texts(texts: DataFrame, path: str, buckets: int = BUCKETS) -> list[int]:
    """Put texts in the place of those with the same name; other files of the table stay as they are.
    Returns the buckets that changed."""
    return text_table(texts.sparkSession, path, buckets).upsert(texts.select("file_name", "text"))


def text_table(spark: SparkSession, path: str, buckets: int = BUCKETS) -> KeyedTable:
    return KeyedTable(spark, path, TEXT_SCHEMA, ["file_name"], buckets)


def json_documents(table: DataFrame, keys: list[str], document: Column | str) -> DataFrame:
    """``(keys..., json)``; null fields are kept."""
    column = F.col(document) if isinstance(document, str) else document
    return table.select(
        *keys, F.to_json(column, {"ignoreNullFields": "false"}).alias("json")
    )


def write_json_documents(
    table: DataFrame, keys: list[str], document: Column | str, path: str
) -> None:
    json_documents(table, keys, document).write.mode("overwrite").parquet(path)


def write_links(
    links: DataFrame, path: str, by: tuple[str, ...] = ("channel", "kind")
) -> None:
    """One link per line, in one folder per channel and kind, in the order of ``pos`` where there is one.

    Tasks hold ranges of (folder, position), so files by name and lines within them give the
    order, also of a list that is many files long; ``texts.ordered_links`` restores
    it. With very many channels give ``by=("kind",)``: files then number with the
    data, not with the channels.
    """
    if "pos" in links.columns:
        links = links.repartitionByRange(*by, "pos").sortWithinPartitions(*by, "pos")
    links.select(*by, "url").write.mode("overwrite").partitionBy(*by).text(path)
