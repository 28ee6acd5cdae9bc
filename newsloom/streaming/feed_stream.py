"""The feed as a stream of packages: same parsing, bounded state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newsloom.fixed_values import FEED_ZONE, FIELD_POSITIONS, PT_CODE, SLOT_MINUTES
from newsloom.functions.language import PORTUGUESE, LanguageRule
from newsloom.functions.times import slot_stamp
from newsloom.operators.feed import about_brazil, in_languages, with_dates
from newsloom.session import read_or_empty
from newsloom.sources.package_source import ROW_FIELDS, read_rows, streamed_lines
from newsloom.sources.packages import feed_rows, package_files, read_packages

LINES_SCHEMA = f"{ROW_FIELDS}, batch bigint, kind string"


def feed_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Feed rows of packages as they land."""
    return feed_rows(read_packages(package_files(spark, folder, stream=True)))


def first_arrivals(
    rows: DataFrame, delay: str = "1 day", key: str = "url", buckets: int = 16
) -> DataFrame:
    """One row per URL, the first to arrive, with state kept for ``delay`` of event time.

    Two stateful steps, both behind the watermark: first per URL and bucket of
    times, so that a URL with a large share of the rows is dealt to many tasks,
    then per URL. Only the watermark drops late rows. Batch keeps the least slot
    and line instead; both agree on ordered input. Rows without a date cannot be
    placed in time and go, as in the day filter.
    """
    bucket = F.pmod(F.xxhash64("date_utc"), F.lit(buckets))
    return (
        rows.filter(F.col("date_utc").isNotNull())
        .withColumn("_bucket", bucket)
        .withWatermark("date_utc", delay)
        .dropDuplicatesWithinWatermark([key, "_bucket"])
        .dropDuplicatesWithinWatermark([key])
        .drop("_bucket")
    )


def slot_statistics(rows: DataFrame, kept: Column, delay: str = "30 minutes") -> DataFrame:
    """Rows and kept rows per slot, each slot once, when the watermark has passed it.

    Later rows are dropped by Spark; ``run_available`` returns their number.
    """
    return (
        rows.withColumn("kept", kept)
        .withWatermark("date_utc", delay)
        .groupBy(F.window("date_utc", f"{SLOT_MINUTES} minutes"))
        .agg(F.count("*").alias("rows"), F.count_if("kept").alias("kept_rows"))
        .select(slot_stamp(F.col("window.start")).alias("slot"), "rows", "kept_rows")
    )


def run_available(stream: DataFrame, path: str, checkpoint: str, *by: str) -> int:
    """Process what has landed since the last run and append it to a Parquet folder.

    Returns the number of rows that came after the watermark and were dropped.

    Offsets, state and the list of written files are kept in ``checkpoint`` and
    ``path``: a run that dies is taken up again without loss or repeats.
    """
    writer = stream.writeStream.format("parquet").outputMode("append")
    if by:
        writer = writer.partitionBy(*by)
    stream.sparkSession.conf.set("spark.sql.streaming.numRecentProgressUpdates", "100000")
    query = (
        writer.option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(
        step.numRowsDroppedByWatermark or 0
        for progress in query.recentProgress
        for step in progress.stateOperators
    )


# ---- packages opened once, everything kept --------------------------------------------

#: What becomes of a line: a row of the feed, a row behind the watermark, a row without a date, a
#: line longer than its package's first, a package that cannot be read.
ROW, LATE, UNDATED, LINE, PACKAGE = "row", "late", "undated", "line", "package"
CLOCK_SCHEMA = "latest timestamp, batch bigint"


def _replaced(rows: DataFrame, path: str, *by: str) -> None:
    """Write the partitions that are present, in place of what they held."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


class Ingest:
    """The stream of packages as one table of lines, each with what became of it.

    A package is opened once. A batch is written in one pass, to folders of its own by batch and
    kind; a batch that is tried again takes the place of its first try. The watermark
    of a batch is the latest date of all batches before it less ``delay``, as Spark
    reckons it, but rows behind it are kept, under ``late``.
    """

    def __init__(self, spark: SparkSession, packages: str, base: str, delay: str = "1 day", files_per_batch: int | None = None):
        self.spark, self.packages, self.delay, self.files_per_batch = spark, packages, delay, files_per_batch
        base = base.rstrip("/")
        self.lines, self.clock, self.checkpoint = f"{base}/lines", f"{base}/clock", f"{base}/checkpoint"

    def _write(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = read_or_empty(spark, self.clock, CLOCK_SCHEMA).where(F.col("batch") < number)
        mark = before.select(F.max("latest") - F.expr(f"INTERVAL {self.delay}")).first()[0]
        late = F.lit(False) if mark is None else F.col("date_utc") < F.lit(mark)
        kind = (
            F.when(F.col("reject").isNotNull(), F.col("reject"))
            .when(F.col("date_utc").isNull(), UNDATED)
            .when(late, LATE)
            .otherwise(ROW)
        )
        seen = Observation()
        rows = read_rows(batch).withColumns({"batch": F.lit(number), "kind": kind})
        rows = rows.observe(seen, F.max(F.when(F.col("kind") == ROW, F.col("date_utc"))).alias("latest"))
        _replaced(rows, self.lines, "batch", "kind")
        latest = spark.createDataFrame([(seen.get["latest"], number)], CLOCK_SCHEMA)
        _replaced(latest, self.clock, "batch")

    def run(self) -> None:
        """Open what has landed since the last run."""
        lines = streamed_lines(self.spark, self.packages, self.files_per_batch)
        query = lines.writeStream.foreachBatch(self._write).option("checkpointLocation", self.checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()

    def of_kind(self, kind: str) -> DataFrame:
        """The lines of one kind; other kinds' files are not read."""
        return read_or_empty(self.spark, self.lines, LINES_SCHEMA).where(F.col("kind") == kind)

    def rows(self) -> DataFrame:
        """Rows in time, as a stream."""
        lines = self.spark.readStream.schema(LINES_SCHEMA).parquet(self.lines)
        return lines.where(F.col("kind") == ROW).select("slot", "row_no", *FIELD_POSITIONS, "date_utc")


def least_arrivals(rows: DataFrame, delay: str = "1 day", key: str = "url") -> DataFrame:
    """One row per URL in the order of the batch: the least slot and line, not the first to arrive.

    A URL is held until ``delay`` has passed since its last row; then its least row is
    given. Rows that far apart, or further, count as a new story: Spark also merges sessions that
    only touch, so the gap is a microsecond short. It is a session window, so state is one row
    per open URL, in the JVM; a hot URL is folded before the shuffle
    (``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition``).
    """
    rows.sparkSession.conf.set(
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true"
    )
    others = [name for name in rows.columns if name != key]
    order = F.struct("slot", "row_no")
    return (
        rows.withWatermark("date_utc", delay)
        .groupBy(F.session_window("date_utc", f"{delay} -1 microseconds"), key)
        .agg(F.min_by(F.struct(*others), order).alias("least"))
        .select(key, "least.*")
    )


def run_news(
    spark: SparkSession,
    packages: str,
    out: str,
    checkpoint: str,
    zone: str = FEED_ZONE,
    wanted: frozenset[str] = frozenset({PT_CODE}),
    brazil: bool = False,
    rules: tuple[LanguageRule, ...] = (PORTUGUESE,),
    delay: str = "1 day",
    rejects: str | None = None,
    least: bool = False,
    files_per_batch: int | None = None,
) -> int:
    """Take up the packages landed since the last run: filter, one row per URL, append by day.

    A row goes out when its URL first arrives, or, with ``least``, as the batch job would choose
    it, once no earlier one can come. Late rows, rows without a date, long lines and bad packages
    stay in ``<checkpoint>-packages`` (see ``Ingest``); bad packages also go to the
    folder ``rejects``, if one is given. Returns the number of late rows so far.
    """
    ingest = Ingest(spark, packages, f"{checkpoint.rstrip('/')}-packages", delay, files_per_batch)
    ingest.run()
    if rejects is not None:
        bad = ingest.of_kind(PACKAGE).select("slot", "path", "error", "batch")
        _replaced(bad, rejects, "batch")
    rows = in_languages(ingest.rows(), wanted, rules)
    if brazil:
        rows = about_brazil(rows)
    single = least_arrivals(rows, delay) if least else first_arrivals(rows, delay)
    run_available(with_dates(single, zone), out, checkpoint, "local_day")
    return ingest.of_kind(LATE).count()
