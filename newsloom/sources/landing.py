"""A table of opened packages: each run opens only what is not in it yet.

Below the base folder: ``rows``, partitioned by UTC day and slot, with the feed's rows and what
was rejected of each package; and ``opened``, a ledger with one row per slot and run.
A package is a task and a slot a partition, so rows are written without any
shuffle, and a slot that is opened again takes the place of its old rows only.
The ledger is written last: a run that dies before is done again without repeats.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.session import read_or_empty
from newsloom.sources import package_source as source

ROW_SCHEMA = f"{source.ROW_FIELDS}, day string"
LEDGER_SCHEMA = "slot string, rows bigint, line_rejects bigint, error string, run int"


def _base(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def slot_day(slot: Column) -> Column:
    return F.substring(slot, 1, 8)


def opened(spark: SparkSession, base: str) -> DataFrame:
    """The ledger: the last opening of each slot, ``slot, rows, line_rejects, error, run``."""
    last = Window.partitionBy("slot").orderBy(F.col("run").desc())
    return (
        read_or_empty(spark, _base(base, "opened"), LEDGER_SCHEMA)
        .withColumn("_place", F.row_number().over(last))
        .where("_place = 1")
        .drop("_place")
    )


def landed(spark: SparkSession, base: str, slots: list[str] | None = None) -> DataFrame:
    """What has been opened, as ``package_source.read_rows`` gives it; ``slots`` cuts partitions."""
    rows = read_or_empty(spark, _base(base, "rows"), ROW_SCHEMA)
    if slots is None:
        return rows
    return rows.where(F.col("day").isin(sorted({s[:8] for s in slots})) & F.col("slot").isin(slots))


@dataclass(frozen=True)
class Landing:
    """Slots a run opened, in order, and the table's rows of the slots it was asked for."""

    opened: list[str]
    rows: DataFrame


def land(
    spark: SparkSession, folder: str, base: str, slots: list[str] | None = None, files_per_task: int = 1
) -> Landing:
    """Open the packages of ``slots`` (all, if not given) that the table does not hold yet.

    A package that could not be read is tried again in every run; one that was read is never
    opened again. File names and the ledger pass through the driver: one short row per slot,
    96 a day. Files whose names carry no stamp are not packages.
    """
    present = {source.slot_of(p) for p in source.listed(folder)} - {None}
    wanted = present if slots is None else present & set(slots)
    ledger = opened(spark, base)
    known = {r.slot for r in ledger.where("error IS NULL").select("slot").collect()}
    due = sorted(wanted - known)
    if due:
        run = (ledger.agg(F.max("run")).first()[0] or 0) + 1
        lines = source.landed_lines(spark, folder, files_per_task)
        rows = source.read_rows(lines.where(F.col("slot").isin(due)))
        (
            rows.withColumn("day", slot_day(F.col("slot")))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "slot")
            .parquet(_base(base, "rows"))
        )
        counts = landed(spark, base, due).groupBy("slot").agg(
            F.count_if(F.col("reject").isNull()).alias("rows"),
            F.count_if(F.col("reject") == "line").alias("line_rejects"),
            F.max("error").alias("error"),
        )
        counts.withColumn("run", F.lit(run)).write.mode("append").parquet(_base(base, "opened"))
    return Landing(due, landed(spark, base, slots))
