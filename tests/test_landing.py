"""Packages as a data source, and the table of what has been opened."""

import csv
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F
from test_packages import full, landed, line, zipped  # noqa: F401

from newsloom.sources import landing, package_source, packages


def rows(spark, folder, *filters):
    lines = package_source.landed_lines(spark, folder)
    for one in filters:
        lines = lines.where(one)
    return package_source.read_rows(lines)


def test_same_rows_as_the_file_reader(spark, landed):  # noqa: F811
    folder = landed(
        s20250825150000=zipped(full("u1") + "\r\n\r\n" + full('"a ""b"" c"')),
        s20250825151500=zipped(line(10, c1="x", c4="u2", c7="seven", c8="eight", c9="nine") + "\n\t\t\t\tshort"),
        s20250825153000=zipped(line(8, c4="u3", c7="NaN")),
        s20250825154500=b"broken",
        s20250825160000=zipped("\n\n"),
        s20250825161500=zipped(b"\xff\xfe\n"),
    )
    raw = packages.read_packages(packages.package_files(spark, folder))
    names = ["slot", "row_no", "date", "source", "url", "themes", "locations", "tone", "translation", "date_utc"]
    found = rows(spark, folder)
    assert sorted(map(str, package_source.accepted(found).select(*names).collect())) == sorted(
        map(str, packages.feed_rows(raw).select(*names).collect())
    )
    rejects = {(r.slot, r.error.split(":")[0]) for r in package_source.package_rejects(found).collect()}
    assert rejects == {
        ("20250825154500", "BadZipFile"), ("20250825160000", "ValueError"), ("20250825161500", "UnicodeDecodeError")
    }


def test_long_lines_are_rows_of_their_own(spark, landed):  # noqa: F811
    body = "\n".join([line(9, c4="a"), line(10, c4="long"), "\t\t\t\tshort", line(9, c4='"x\ty"')])
    found = rows(spark, landed(s20250825150000=zipped(body)))
    assert [(r.row_no, r.url) for r in package_source.accepted(found).orderBy("row_no").collect()] == [
        (0, "a"), (2, "short"), (3, "x\ty")
    ]
    reject = package_source.line_rejects(found).collect()
    assert [(r.slot, r.row_no, r.width, r.n_cells, r.line) for r in reject] == [
        ("20250825150000", 1, 9, 10, line(10, c4="long"))
    ]


def test_cells_as_the_csv_module_reads_them(spark):
    draw = random.Random(8)
    pieces = ["a", "b c", '"', '""', "\t", "é", "\\", ",", "'"]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randint(1, 12))) for _ in range(600)]
    texts += ["\t", '"', '""', '"a', '"a"b"c"\td', '\t"a\tb"', 'a"b\tc', '"' + "x" * 50_000 + '"\ty', "\t" * 300]
    table = spark.createDataFrame(list(enumerate(texts)), "i int, line string")
    found = {r.i: r.cells for r in table.select("i", package_source.cells(F.col("line")).alias("cells")).collect()}
    for i, text in enumerate(texts):
        assert found[i] == next(csv.reader([text], delimiter="\t")), text


def test_filters_on_slots_keep_files_closed(spark, landed):  # noqa: F811
    stamps = [f"2025082515{m}00" for m in ("00", "15", "30", "45")]
    folder = landed(**{f"s{s}": zipped(full(s)) for s in stamps})
    slot = F.col("slot")
    cases = [
        (slot == stamps[1], stamps[1:2]),
        (slot.isin(stamps[0], stamps[3], "x"), [stamps[0], stamps[3]]),
        ((slot >= stamps[1]) & (slot < stamps[3]), stamps[1:3]),
        ((slot > stamps[1]) & (slot <= stamps[3]), stamps[2:]),
        (slot.startswith("20250826"), []),
        (slot != stamps[0], stamps[1:]),
    ]
    for condition, expected in cases:
        found = rows(spark, folder, condition)
        assert sorted(r.slot for r in found.collect()) == expected
        tasks = package_source.landed_lines(spark, folder).where(condition).rdd.getNumPartitions()
        assert tasks == (4 if condition is cases[-1][0] else max(len(expected), 1))


def test_written_packages_are_read_back(spark, tmp_path):
    lines = [(f"202508251{k % 3}0000", k, full(f"u{k}")) for k in range(30)]
    table = spark.createDataFrame(lines, "slot string, row_no long, line string")
    ordered = table.repartition(2, "slot").sortWithinPartitions("slot", "row_no")
    package_source.use_packages(spark)
    folder = str(tmp_path / "out")
    ordered.write.format(package_source.FORMAT).mode("append").save(folder)
    assert len(package_source.listed(folder)) == 3
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.endswith(".zip")) == []
    with zipfile.ZipFile(io.BytesIO((tmp_path / "out" / "20250825100000.gkg.csv.zip").read_bytes())) as archive:
        assert archive.namelist() == ["20250825100000.gkg.csv"]
    found = package_source.accepted(rows(spark, folder)).orderBy("slot", "row_no").collect()
    assert [(r.slot, r.url) for r in found] == [(s, f"u{k}") for s, k, _ in sorted(lines)]


@pytest.fixture
def two_runs(spark, landed, tmp_path):  # noqa: F811
    base = str(tmp_path / "table")
    folder = landed(s20250825150000=zipped(full("a") + "\n" + full("b") + "\tmore"), s20250825151500=b"broken")
    first = landing.land(spark, folder, base)
    # What has been opened may go or change; it is not read again.
    landed(s20250825150000=b"gone", s20250825151500=zipped(full("mended")), s20250826000000=zipped(full("new")))
    second = landing.land(spark, folder, base)
    return folder, base, first.opened, second


def test_a_run_opens_new_and_failed_packages_only(spark, two_runs):
    folder, base, first, second = two_runs
    assert first == ["20250825150000", "20250825151500"]
    assert second.opened == ["20250825151500", "20250826000000"]
    found = sorted((r.slot, r.url) for r in package_source.accepted(second.rows).collect())
    assert found == [("20250825150000", "a"), ("20250825151500", "mended"), ("20250826000000", "new")]
    assert package_source.package_rejects(second.rows).count() == 0
    assert [r.slot for r in package_source.line_rejects(second.rows).collect()] == ["20250825150000"]
    assert landing.land(spark, folder, base).opened == []
    ledger = {r.slot: (r.run, r["rows"], r.line_rejects, r.error) for r in landing.opened(spark, base).collect()}
    assert ledger == {
        "20250825150000": (1, 1, 1, None), "20250825151500": (2, 1, 0, None), "20250826000000": (2, 1, 0, None)
    }


def test_slots_cut_partitions(spark, two_runs):
    _, base, _, _ = two_runs
    cut = landing.landed(spark, base, ["20250826000000"])
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert [r.url for r in cut.collect()] == ["new"]
    assert {f.rsplit("slot=", 1)[1][:14] for f in cut.inputFiles()} >= {"20250826000000"}


def test_nothing_landed(spark, tmp_path):
    folder = tmp_path / "none"
    folder.mkdir()
    run = landing.land(spark, str(folder), str(tmp_path / "table"))
    assert run.opened == [] and run.rows.collect() == []


def test_streamed_lines_equal_batch(spark, landed, tmp_path):  # noqa: F811
    folder = landed(s20250825150000=zipped(full("a")), s20250825151500=b"broken")
    stream = package_source.read_rows(package_source.streamed_lines(spark, folder))
    out = str(tmp_path / "out")
    writer = stream.writeStream.format("parquet").option("path", out)
    writer.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    names = ["slot", "row_no", "url", "reject"]
    key = lambda table: sorted(map(str, table.select(*names).collect()))
    assert key(spark.read.parquet(out)) == key(rows(spark, folder))
