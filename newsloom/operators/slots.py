"""Expected slots and what has arrived."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.fixed_values import FEED_ZONE, SLOT_MINUTES
from newsloom.functions.times import (
    day_bounds,
    day_start,
    instant,
    local_day,
    package_name,
    slot_start,
    slot_stamp,
)


def slot_counts(rows: DataFrame, ts: str) -> DataFrame:
    """Rows per 15-minute slot."""
    return (
        rows.groupBy(slot_start(F.col(ts)).alias("slot_start"))
        .agg(F.count("*").alias("n"))
        .select(slot_stamp(F.col("slot_start")).alias("slot"), "n")
    )


def expand_slots(spans: DataFrame, start: Column, end: Column, base: str = "") -> DataFrame:
    """One row per slot from ``start`` to ``end`` inclusive, next to the span's columns."""
    step = F.make_dt_interval(mins=F.lit(SLOT_MINUTES))
    stamped = spans.withColumn("slot_start", F.explode(F.sequence(start, end, step)))
    stamped = stamped.withColumn("slot", slot_stamp(F.col("slot_start")))
    return stamped.withColumn("package", package_name(F.col("slot"), base))


def manifest(
    spark: SparkSession,
    as_of: datetime,
    zone: str = FEED_ZONE,
    window_minutes: int = 0,
    base: str = "",
) -> DataFrame:
    """Expected packages at ``as_of``: since local midnight, or of the last minutes."""
    start = day_bounds(as_of, zone)[0]
    if window_minutes > 0:
        first = as_of.astimezone(timezone.utc) - timedelta(minutes=window_minutes)
        start = first - timedelta(
            minutes=first.minute % SLOT_MINUTES,
            seconds=first.second,
            microseconds=first.microsecond,
        )
    span = spark.range(1).select(F.lit(start).alias("start"), F.lit(as_of).alias("end"))
    slots = expand_slots(span, F.col("start"), F.col("end"), base)
    return slots.select("slot_start", "slot", "package")


def daily_manifest(
    rows: DataFrame, ts: str, zone: str = FEED_ZONE, window_minutes: int = 0
) -> DataFrame:
    """The manifest of every local day of a table, as of the day's last row."""
    days = (
        rows.select(instant(F.col(ts)).alias("at"))
        .groupBy(local_day(F.col("at"), zone).alias("local_day"))
        .agg(F.max("at").alias("as_of"))
    )
    start = day_start(F.col("local_day"), zone)
    if window_minutes > 0:
        start = slot_start(F.col("as_of") - F.make_dt_interval(mins=F.lit(window_minutes)))
    slots = expand_slots(days, start, F.col("as_of"))
    return slots.select("local_day", "slot_start", "slot", "package")


def missing_slots(expected: DataFrame, arrived: DataFrame) -> DataFrame:
    """Expected slots nothing arrived for. ``arrived`` has a ``slot`` column and is
    brought down to one row per slot before the join."""
    return expected.join(arrived.select("slot").distinct(), "slot", "left_anti")


def arrival_counts(expected: DataFrame, arrived: DataFrame, *by: str) -> DataFrame:
    """Arrived and missing slots, in all or per ``by``."""
    marks = arrived.select("slot").distinct().withColumn("here", F.lit(True))
    return (
        expected.join(marks, "slot", "left")
        .groupBy(*by)
        .agg(
            F.count_if(F.col("here").isNotNull()).alias("ok"),
            F.count_if(F.col("here").isNull()).alias("missing"),
        )
    )
