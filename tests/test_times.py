from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from newsloom.functions import times
from newsloom.operators import slots

UTC = timezone.utc


def stamp(text):
    return datetime.strptime(text, "%Y%m%d%H%M%S").replace(tzinfo=UTC)


def test_slot_is_floored_also_before_1970(one):
    found = one(
        ["20250825153000", "20250825154459", "19691231235959"],
        times.slot_stamp(times.slot_start(times.parse_stamp(F.col("v")))),
    )
    assert found == ["20250825153000", "20250825153000", "19691231234500"]


def test_stamp_needs_fourteen_digits(one):
    texts = ["20250825153000", "2025082515300", "20250231000000", "x", "", None]
    found = one(texts, F.unix_seconds(times.parse_stamp(F.col("v"))))
    assert found == [int(stamp("20250825153000").timestamp()), None, None, None, None, None]


def test_package_name_and_back(one):
    name = times.package_name(F.col("v"), "s3a://feed/")
    assert one(["20250825153000"], name) == ["s3a://feed/20250825153000.gkg.csv.zip"]
    paths = ["hdfs://x/20250825153000.gkg.csv.zip", "20250825153000.zip", "/a/other.zip"]
    assert one(paths, times.package_stamp(F.col("v"))) == ["20250825153000"] * 2 + [None]


@pytest.mark.parametrize(
    "zone, text",
    [
        ("America/Boa_Vista", "2025-08-25 11:30:00-0400"),
        ("America/St_Johns", "2025-08-25 13:00:00-0230"),
        ("Asia/Kathmandu", "2025-08-25 21:15:00+0545"),
        ("UTC", "2025-08-25 15:30:00+0000"),
    ],
)
def test_iso_text(one, zone, text):
    at = times.parse_stamp(F.col("v"))
    assert one(["20250825153000"], times.iso_local(at, zone)) == [text]
    assert one(["20250825153000"], times.iso_utc(at)) == ["2025-08-25 15:30:00+0000"]


def test_day_edges(one):
    as_of = stamp("20250825153000")
    texts = ["20250825035959", "20250825040000", "20250826035959", "20250826040000"]
    test = times.within_local_day(times.parse_stamp(F.col("v")), as_of, "America/Boa_Vista")
    assert one(texts, test) == [False, True, True, False]


def test_day_with_clock_change_keeps_its_length():
    start, end = times.day_bounds(stamp("20241103120000"), "America/New_York")
    assert (end.astimezone(UTC) - start.astimezone(UTC)).total_seconds() == 25 * 3600


def test_as_of_needs_a_zone():
    with pytest.raises(ValueError):
        times.day_bounds(datetime(2025, 1, 1), "UTC")


def test_manifest_from_midnight_and_by_window(spark):
    as_of = stamp("20250825050700")
    day = slots.manifest(spark, as_of, "America/Boa_Vista", base="landing")
    assert [r.slot for r in day.orderBy("slot").collect()] == [
        f"2025082504{m}00" for m in ("00", "15", "30", "45")
    ] + ["20250825050000"]
    assert day.first().package.startswith("landing/2025")
    window = slots.manifest(spark, as_of, "America/Boa_Vista", window_minutes=30)
    assert [r.slot for r in window.orderBy("slot").collect()] == [
        "20250825043000", "20250825044500", "20250825050000"
    ]
    on_time = slots.manifest(spark, stamp("20250825041500"), "America/Boa_Vista")
    assert on_time.count() == 2  # both ends count


def test_arrived_and_missing(spark):
    expected = slots.manifest(spark, stamp("20250825050700"), "America/Boa_Vista")
    arrived = spark.createDataFrame(
        [("20250825040000",), ("20250825040000",), ("20250825044500",), ("x",)], "slot string"
    )
    missing = slots.missing_slots(expected, arrived)
    assert sorted(r.slot for r in missing.collect()) == [
        "20250825041500", "20250825043000", "20250825050000"
    ]
    counts = slots.arrival_counts(expected, arrived).first()
    assert (counts.ok, counts.missing) == (2, 3)
