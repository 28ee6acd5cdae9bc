"""Landed 15-minute packages: zip files with one headerless tab file each.

Spark has no zip codec, so the bytes of a package become rows in
``mapInPandas``; everything after that is native. A package that cannot be
read becomes one row with its error, never a silent loss. Packages are
independent files, so a task reads as many as fit its split, and a lost
executor only means reading them again.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.fixed_values import FIELD_POSITIONS, NULL_CELLS, PACKAGE_SUFFIX
from newsloom.functions.times import package_stamp, parse_stamp

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
POSITIONS = sorted({p for places in FIELD_POSITIONS.values() for p in places})
RAW_SCHEMA = "path string, row_no bigint, width int, error string, " + ", ".join(
    f"c{p} string" for p in POSITIONS
)
RAW_COLUMNS = ["path", "row_no", "width", "error", *(f"c{p}" for p in POSITIONS)]
ROWS_PER_BATCH = 20_000


def package_files(
    spark: SparkSession, folder: str, stream: bool = False, pattern: str = "*" + PACKAGE_SUFFIX
) -> DataFrame:
    """The landed files, as a table or as a stream.

    Cut by slot here, through ``folder`` or ``pattern``: no filter passes the
    Python step that follows.
    """
    reader = spark.readStream.schema(FILE_SCHEMA) if stream else spark.read
    return reader.format("binaryFile").option("pathGlobFilter", pattern).load(folder)


def _cells(line: str) -> list[str]:
    if '"' in line:
        return next(csv.reader([line], delimiter="\t"))
    return line.split("\t")


def _read_package(path: str, content: bytes) -> Iterator[list]:
    """Rows of one package: the first line sets the width, longer lines are left out,
    shorter ones are filled with nulls, quotes are read line by line."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        text = archive.read(archive.namelist()[0]).decode("utf-8")
    nulls = set(NULL_CELLS)
    width = 0
    row_no = 0
    for line in io.StringIO(text):
        line = line.rstrip("\r\n")
        if not line:
            continue
        cells = _cells(line)
        width = width or len(cells)
        if len(cells) > width:
            continue
        kept = [cells[p] if p < len(cells) else None for p in POSITIONS]
        yield [path, row_no, width, None, *(None if c in nulls else c for c in kept)]
        row_no += 1
    if row_no == 0:
        raise ValueError("no rows")


def _read_packages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    csv.field_size_limit(2**31 - 1)
    ready: list[list] = []
    for files in batches:
        for path, content in zip(files["path"], files["content"]):
            try:
                rows = list(_read_package(path, content))
            except Exception as problem:  # any fault rejects the whole package
                reason = f"{type(problem).__name__}: {problem}"
                rows = [[path, None, None, reason, *([None] * len(POSITIONS))]]
            ready.extend(rows)
            while len(ready) >= ROWS_PER_BATCH:
                yield pd.DataFrame(ready[:ROWS_PER_BATCH], columns=RAW_COLUMNS)
                del ready[:ROWS_PER_BATCH]
    if ready:
        yield pd.DataFrame(ready, columns=RAW_COLUMNS)


def read_packages(files: DataFrame) -> DataFrame:
    """Raw rows ``(path, row_no, width, error, c1, c3, ...)``, one error row per bad package."""
    return files.select("path", "content").mapInPandas(_read_packages, RAW_SCHEMA)


def _field(places: tuple[int, ...]) -> Column:
    """The cell at the first position the package is wide enough for, else ``''``."""
    choice = F.lit("")
    for place in reversed(places):
        choice = F.when(F.col("width") > place, F.col(f"c{place}")).otherwise(choice)
    return choice


def field_columns() -> list[Column]:
    """The seven fields by position; a null becomes ``''`` in every field but ``date``."""
    return [
        (_field(places) if name == "date" else F.coalesce(_field(places), F.lit(""))).alias(name)
        for name, places in FIELD_POSITIONS.items()
    ]


def feed_rows(raw: DataFrame) -> DataFrame:
    """The seven fields, ``date_utc``, and where the row came from."""
    return (
        raw.filter(F.col("error").isNull())
        .select(package_stamp(F.col("path")).alias("slot"), "row_no", *field_columns())
        .withColumn("date_utc", parse_stamp(F.col("date")))
    )


def rejected_packages(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("error").isNotNull()).select(
        package_stamp(F.col("path")).alias("slot"), "path", "error"
    )
