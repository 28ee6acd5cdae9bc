"""Slots, stamps and local time.

Instants are TIMESTAMP columns under a UTC session; a local wall clock is a
TIMESTAMP_NTZ plus its offset, because Spark keeps no zone per value.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.fixed_values import PACKAGE_SUFFIX, SLOT_MINUTES

STAMP = "yyyyMMddHHmmss"
WALL = "yyyy-MM-dd HH:mm:ss"


def instant(ts: Column) -> Column:
    """A zone-less wall clock read as UTC."""
    return ts.cast("timestamp")


def slot_start(ts: Column) -> Column:
    """Floor to the 15-minute slot."""
    seconds = F.unix_seconds(instant(ts))
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(SLOT_MINUTES * 60)))


def slot_stamp(ts: Column) -> Column:
    return F.date_format(ts, STAMP)


def package_name(stamp: Column, base: str = "") -> Column:
    """Stamp to package name, below ``base`` when given."""
    prefix = base.rstrip("/") + "/" if base else ""
    return F.concat(F.lit(prefix), stamp, F.lit(PACKAGE_SUFFIX))


def package_stamp(path: Column) -> Column:
    """Package path back to its stamp; null when the name carries none."""
    return F.nullif(F.regexp_extract(path, r"(?:^|/)(\d{14})[^/]*$", 1), F.lit(""))


def parse_stamp(text: Column) -> Column:
    """``yyyyMMddHHmmss`` as an instant; anything else is null."""
    return F.try_to_timestamp(text, F.lit(STAMP))


def local_wall(ts: Column, zone: str) -> Column:
    """Wall clock of an instant in ``zone``, as TIMESTAMP_NTZ."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), instant(ts).cast("timestamp_ntz"))


def local_day(ts: Column, zone: str) -> Column:
    return F.to_date(local_wall(ts, zone))


def day_start(day: Column, zone: str) -> Column:
    """Instant at which a local date begins."""
    return instant(F.convert_timezone(F.lit(zone), F.lit("UTC"), day.cast("timestamp_ntz")))


def offset_minutes(ts: Column, zone: str) -> Column:
    wall = local_wall(ts, zone).cast("timestamp")
    return ((F.unix_seconds(wall) - F.unix_seconds(instant(ts))) / 60).cast("int")


def offset_text(ts: Column, zone: str) -> Column:
    """``+hhmm`` / ``-hhmm``, no colon."""
    minutes = offset_minutes(ts, zone)
    size = F.abs(minutes)
    hours = F.lpad((size / 60).cast("int").cast("string"), 2, "0")
    rest = F.lpad((size % 60).cast("string"), 2, "0")
    return F.concat(F.when(minutes < 0, "-").otherwise("+"), hours, rest)


def iso_local(ts: Column, zone: str) -> Column:
    return F.concat(F.date_format(local_wall(ts, zone), WALL), offset_text(ts, zone))


def iso_utc(ts: Column) -> Column:
    return F.concat(F.date_format(ts, WALL), F.lit("+0000"))


def day_bounds(as_of: datetime, zone: str) -> tuple[datetime, datetime]:
    """The local day around ``as_of``: first instant, and first instant of the next day.

    Both come from local dates, so a day of 23 or 25 hours keeps its length.
    """
    if as_of.tzinfo is None:
        raise ValueError("as_of needs a time zone")
    tz = ZoneInfo(zone)
    day = as_of.astimezone(tz).date()
    midnight = datetime(day.year, day.month, day.day)
    return midnight.replace(tzinfo=tz), (midnight + timedelta(days=1)).replace(tzinfo=tz)


def within_local_day(ts: Column, as_of: datetime, zone: str) -> Column:
    """Rows of the local day; literal bounds, so the test reaches a Parquet scan."""
    start, end = day_bounds(as_of, zone)
    return (ts >= F.lit(start)) & (ts < F.lit(end))
