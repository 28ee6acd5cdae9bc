"""Landed packages as a data source of their own: ``spark.read.format("news_packages")``.

A partition is one zip file (or ``files_per_task`` of them). A filter on ``slot`` is taken
up when the files are listed, so packages of other slots are never opened. The
source hands over lines in Arrow batches; cells are taken apart in the JVM. What cannot be
read is a row as well: a package with its error, a line with too many cells.

Files are listed and opened through ``pyarrow.fs``, which reaches local and shared
folders, S3, GCS and HDFS. The writer is the same in reverse: one zip per slot.
"""

from __future__ import annotations

import csv
import io
import os
import posixpath
import re
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from newsloom.fixed_values import FIELD_POSITIONS, NULL_CELLS, PACKAGE_SUFFIX
from newsloom.functions.times import parse_stamp
from newsloom.sources.packages import FILE_SCHEMA, POSITIONS, field_columns

FORMAT = "news_packages"
LINE_SCHEMA = "path string, slot string, row_no bigint, width int, line string, error string"
ARROW_SCHEMA = pa.schema(
    [
        ("path", pa.string()),
        ("slot", pa.string()),
        ("row_no", pa.int64()),
        ("width", pa.int32()),
        ("line", pa.string()),
        ("error", pa.string()),
    ]
)
#: What ``read_rows`` gives of a line.
ROW_FIELDS = (
    "path string, slot string, row_no bigint, date string, source string, url string, themes string, "
    "locations string, tone string, translation string, reject string, error string, width int, "
    "n_cells int, line string, date_utc timestamp"
)
LINES_PER_BATCH = 20_000
STAMP = re.compile(r"(\d{14})[^/]*$")


def slot_of(path: str) -> str | None:
    """The 14 digits at the start of a package's name."""
    found = STAMP.match(path.rsplit("/", 1)[-1])
    return found and found[1]


# ---- one package, inside a task ----------------------------------------------------


def _width(line: str) -> int:
    if '"' in line:
        return len(next(csv.reader([line], delimiter="\t")))
    return line.count("\t") + 1


def package_lines(path: str, content: bytes) -> Iterator[pa.RecordBatch]:
    """The lines of a package that are not blank, numbered from 0; ``width`` is the first
    line's number of cells. A package that cannot be read is one row with its error."""
    slot = slot_of(path)
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            text = archive.read(archive.namelist()[0]).decode("utf-8")
        lines = [line for line in (x.rstrip("\r") for x in text.split("\n")) if line]
        if not lines:
            raise ValueError("no rows")
        width = _width(lines[0])
    except Exception as problem:  # any fault rejects the whole package
        reason = f"{type(problem).__name__}: {problem}"
        row = {"path": path, "slot": slot, "row_no": None, "width": None, "line": None, "error": reason}
        yield pa.RecordBatch.from_pylist([row], schema=ARROW_SCHEMA)
        return
    for start in range(0, len(lines), LINES_PER_BATCH):
        some = lines[start : start + LINES_PER_BATCH]
        n = len(some)
        yield pa.RecordBatch.from_arrays(
            [
                pa.repeat(pa.scalar(path, pa.string()), n),
                pa.repeat(pa.scalar(slot, pa.string()), n),
                pa.array(range(start, start + n), pa.int64()),
                pa.repeat(pa.scalar(width, pa.int32()), n),
                pa.array(some, pa.string()),
                pa.nulls(n, pa.string()),
            ],
            schema=ARROW_SCHEMA,
        )


def opened_folder(folder: str):
    """A file system and the folder's path in it."""
    from pyarrow import fs

    if re.match(r"file:/(?!/)", folder):
        folder = folder[len("file:") :]
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), os.path.abspath(folder)


def listed(folder: str, suffix: str = PACKAGE_SUFFIX) -> list[str]:
    """Paths of the packages in a folder, by name."""
    from pyarrow import fs

    system, base = opened_folder(folder)
    found = system.get_file_info(fs.FileSelector(base, allow_not_found=True))
    return sorted(f.path for f in found if f.is_file and f.base_name.endswith(suffix))


@dataclass
class _Files(ds.InputPartition):
    paths: list[str]


class _Reader(ds.DataSourceReader):
    """Keeps the files whose slot passes the filters it was given."""

    #: Filters on ``slot`` and what they ask of a value; a null slot passes none.
    TESTS = {
        ds.EqualTo: lambda slot, f: slot == f.value,
        ds.In: lambda slot, f: slot in f.value,
        ds.GreaterThan: lambda slot, f: slot > f.value,
        ds.GreaterThanOrEqual: lambda slot, f: slot >= f.value,
        ds.LessThan: lambda slot, f: slot < f.value,
        ds.LessThanOrEqual: lambda slot, f: slot <= f.value,
        ds.StringStartsWith: lambda slot, f: slot.startswith(f.value),
        ds.IsNotNull: lambda slot, f: True,
    }

    def __init__(self, folder: str, suffix: str, files_per_task: int):
        self.folder, self.suffix, self.files_per_task = folder, suffix, files_per_task
        self.pushed: list[ds.Filter] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:
        for one in filters:
            if type(one) in self.TESTS and one.attribute == ("slot",):
                self.pushed.append(one)
            else:
                yield one

    def _passes(self, path: str) -> bool:
        slot = slot_of(path)
        return all(slot is not None and self.TESTS[type(f)](slot, f) for f in self.pushed)

    def partitions(self) -> Sequence[ds.InputPartition]:
        paths = [p for p in listed(self.folder, self.suffix) if self._passes(p)]
        step = self.files_per_task
        return [_Files(paths[a : a + step]) for a in range(0, len(paths), step)]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        system, _ = opened_folder(self.folder)
        for path in partition.paths:
            with system.open_input_stream(path) as file:
                content = file.read()
            yield from package_lines(path, content)


@dataclass
class _Written(ds.WriterCommitMessage):
    names: list[str]


class _Writer(ds.DataSourceWriter):
    """One zip per slot. Rows of a slot must stand together, in order, in one task.

    Files are written under another name first and take their own in ``commit``, so a task
    that is tried again, or a job that fails, leaves no half package in sight.
    """

    def __init__(self, folder: str, suffix: str):
        self.folder, self.suffix = folder, suffix
        self.run = f"_writing-{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> _Written:
        from pyspark import TaskContext

        system, base = opened_folder(self.folder)
        context = TaskContext.get()
        attempt = posixpath.join(base, self.run, f"{context.partitionId()}-{context.taskAttemptId()}")
        system.create_dir(attempt, recursive=True)
        names, slot, lines = [], None, []

        def close() -> None:
            if slot is None:
                return
            body = io.BytesIO()
            with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr(f"{slot}{self.suffix.removesuffix('.zip')}", "\n".join(lines) + "\n")
            name = posixpath.join(attempt, f"{slot}{self.suffix}")
            with system.open_output_stream(name) as file:
                file.write(body.getvalue())
            names.append(name)

        for row in rows:
            if row["slot"] != slot:
                close()
                slot, lines = row["slot"], []
            lines.append(row["line"])
        close()
        return _Written(names)

    def commit(self, messages: list) -> None:
        system, base = opened_folder(self.folder)
        for message in messages:
            for name in message.names if message else []:
                system.move(name, posixpath.join(base, posixpath.basename(name)))
        self.abort(messages)

    def abort(self, messages: list) -> None:
        """What is left of the run's own folder goes."""
        from pyarrow import fs

        system, base = opened_folder(self.folder)
        own = posixpath.join(base, self.run)
        if system.get_file_info(own).type == fs.FileType.Directory:
            system.delete_dir(own)


class PackageSource(ds.DataSource):
    """Options: ``path``; ``suffix`` of the files; ``files_per_task``, 1 by default."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LINE_SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(
            self.options["path"],
            self.options.get("suffix", PACKAGE_SUFFIX),
            int(self.options.get("files_per_task", "1")),
        )

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], self.options.get("suffix", PACKAGE_SUFFIX))


def use_packages(spark: SparkSession) -> SparkSession:
    """Make the format known to the session, with its filters passed on to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PackageSource)
    return spark


def landed_lines(spark: SparkSession, folder: str, files_per_task: int = 1) -> DataFrame:
    """Lines of the packages in a folder, as in ``LINE_SCHEMA``; filter by ``slot``."""
    reader = use_packages(spark).read.format(FORMAT).option("files_per_task", files_per_task)
    return reader.load(folder)


def streamed_lines(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The same lines as packages land; Spark's file source keeps the list of what was read."""
    reader = spark.readStream.schema(FILE_SCHEMA).format("binaryFile")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return lines_of_files(reader.option("pathGlobFilter", "*" + PACKAGE_SUFFIX).load(folder))


def lines_of_files(files: DataFrame) -> DataFrame:
    """Lines of packages given as ``(path, content)`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                yield from package_lines(path.as_py(), content.as_py() or b"")

    return files.select("path", "content").mapInArrow(run, LINE_SCHEMA)


# ---- lines to cells, in the JVM --------------------------------------------------------

# A cell that begins with a quote ends at the next lone one; what follows up to the tab
# belongs to it. Two quotes inside stand for one. Each token begins with its tab.
QUOTED_TOKEN = r'\t("[^"]*+(?:""[^"]*+)*+(?:"[^\t]*)?|[^\t]*)'
QUOTED_CELL = r'^"([^"]*+(?:""[^"]*+)*+)"?([^\t]*)$'


def _unquoted(token: Column) -> Column:
    inside = F.replace(F.regexp_extract(token, QUOTED_CELL, 1), F.lit('""'), F.lit('"'))
    after = F.regexp_extract(token, QUOTED_CELL, 2)
    return F.when(F.startswith(token, F.lit('"')), F.concat(inside, after)).otherwise(token)


def cells(line: Column) -> Column:
    """The cells of a tab-separated line; quotes are read within the line."""
    quoted = F.transform(
        F.regexp_extract_all(F.concat(F.lit("\t"), line), F.lit(QUOTED_TOKEN), F.lit(1)), _unquoted
    )
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, "\t", -1))


def _taken_apart(lines: DataFrame) -> DataFrame:
    """Adds ``n_cells`` and the cells that fields are read from, nulls where they read as such."""

    def read(of: Column) -> Column:
        kept = [
            F.when(~F.get(of, F.lit(p)).isin(NULL_CELLS), F.get(of, F.lit(p))).alias(f"c{p}") for p in POSITIONS
        ]
        return F.struct(F.size(of).alias("n_cells"), *kept)

    # In a lambda, so that a line is taken apart once and not once per field.
    one = F.get(F.transform(F.array(cells(F.col("line"))), read), F.lit(0))
    return lines.select("path", "slot", "row_no", "width", "line", "error", one.alias("_cells")).select(
        "path", "slot", "row_no", "width", "line", "error", "_cells.*"
    )


def read_rows(lines: DataFrame) -> DataFrame:
    """Every line with its seven fields, ``date_utc``, and ``reject``: null for a row of the feed,
    ``package`` for a package that cannot be read, ``line`` for a line longer than its package's first."""
    too_long = F.col("n_cells") > F.col("width")
    reject = F.when(F.col("error").isNotNull(), "package").when(too_long, "line")
    return _taken_apart(lines).select(
        "path",
        "slot",
        "row_no",
        *field_columns(),
        reject.alias("reject"),
        "error",
        "width",
        "n_cells",
        F.when(too_long, F.col("line")).alias("line"),
    ).withColumn("date_utc", parse_stamp(F.col("date")))


def accepted(rows: DataFrame) -> DataFrame:
    """The feed: rows that nothing was wrong with."""
    return rows.where("reject IS NULL").select("slot", "row_no", *FIELD_POSITIONS, "date_utc")


def line_rejects(rows: DataFrame) -> DataFrame:
    """Lines with more cells than the first of their package."""
    return rows.where("reject = 'line'").select("slot", "path", "row_no", "width", "n_cells", "line")


def package_rejects(rows: DataFrame) -> DataFrame:
    """Packages that cannot be read."""
    return rows.where("reject = 'package'").select("slot", "path", "error")
