import io
import zipfile

import pytest

from newsloom.sources import packages


def line(width=27, **cells):
    out = [""] * width
    for place, cell in cells.items():
        out[int(place[1:])] = cell
    return "\t".join(out)


def zipped(body, *others):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("first.csv", body)
        for i, other in enumerate(others):
            archive.writestr(f"other{i}.csv", other)
    return out.getvalue()


def full(url, **more):
    return line(c1="20250825153000", c3="src", c4=url, c8="T", c10="L", c15="-1,2",
                c25="srclc:por", **more)


@pytest.fixture
def landed(tmp_path):
    def land(**files):
        for name, content in files.items():
            (tmp_path / f"{name[1:]}.gkg.csv.zip").write_bytes(content)
        return str(tmp_path)

    return land


def read(spark, folder):
    raw = packages.read_packages(packages.package_files(spark, folder))
    rows = packages.feed_rows(raw).orderBy("slot", "row_no").collect()
    return rows, packages.rejected_packages(raw).orderBy("slot").collect()


def test_fields_by_position_and_width(spark, landed):
    folder = landed(
        s20250825150000=zipped(full("u1") + "\n"),
        s20250825151500=zipped(line(10, c1="x", c4="u2", c7="seven", c8="eight", c9="nine")),
        s20250825153000=zipped(line(8, c4="u3", c7="seven")),
    )
    rows, rejects = read(spark, folder)
    assert not rejects
    wide, ten, eight = rows
    assert (wide.source, wide.url, wide.themes, wide.locations, wide.tone, wide.translation) == (
        "src", "u1", "T", "L", "-1,2", "srclc:por"
    )
    assert wide.slot == "20250825150000" and wide.date_utc.isoformat() == "2025-08-25T15:30:00"
    assert (ten.themes, ten.locations, ten.tone, ten.date_utc) == ("eight", "nine", "", None)
    assert (eight.themes, eight.locations, eight.date) == ("seven", "", None)


def test_fallback_follows_the_width_not_a_null_cell(spark, landed):
    rows, _ = read(spark, landed(s20250825150000=zipped(line(11, c4="u", c7="seven", c9="nine"))))
    assert (rows[0].themes, rows[0].locations) == ("", "")


def test_first_line_sets_the_width(spark, landed):
    body = "\n".join([line(9, c4="a", c8="t"), line(10, c4="long"), "\t\t\t\tshort", "", line(9, c4="b")])
    rows, _ = read(spark, landed(s20250825150000=zipped(body)))
    assert [(r.row_no, r.url, r.themes) for r in rows] == [(0, "a", "t"), (1, "short", ""), (2, "b", "")]


def test_quotes_nulls_and_line_ends(spark, landed):
    body = "\r\n".join(
        [
            line(9, c1="NA", c3="null", c4='"q\t""x"""', c8="None"),
            line(9, c4='"open', c8="t"),
            line(9, c4="mid\"dle", c8="-nan"),
        ]
    )
    rows, _ = read(spark, landed(s20250825150000=zipped(body)))
    assert [(r.date, r.source, r.url, r.themes) for r in rows][0] == (None, "", 'q\t"x"', "")
    assert rows[2].url == 'mid"dle' and rows[2].themes == ""
    assert len(rows) == 3


def test_only_the_first_entry_counts(spark, landed):
    rows, _ = read(spark, landed(s20250825150000=zipped(full("a"), full("b"))))
    assert [r.url for r in rows] == ["a"]


def test_bad_packages_are_reported_whole(spark, landed):
    folder = landed(
        s20250825150000=b"not a zip",
        s20250825151500=zipped(full("good").encode() + b"\n\xff\xfe\n"),
        s20250825153000=zipped(""),
        s20250825154500=zipped(full("fine")),
    )
    rows, rejects = read(spark, folder)
    assert [r.url for r in rows] == ["fine"]
    assert [(r.slot, r.error.split(":")[0]) for r in rejects] == [
        ("20250825150000", "BadZipFile"),
        ("20250825151500", "UnicodeDecodeError"),
        ("20250825153000", "ValueError"),
    ]


def test_other_files_are_not_listed(spark, landed, tmp_path):
    (tmp_path / "notes.txt").write_text("x")
    rows, rejects = read(spark, landed(s20250825150000=zipped(full("a"))))
    assert len(rows) == 1 and not rejects


def test_batches_of_many_rows(spark, landed, monkeypatch):
    body = "\n".join(full(f"u{i}") for i in range(45_000))
    rows = packages.read_packages(
        packages.package_files(spark, landed(s20250825150000=zipped(body)))
    )
    assert rows.count() == 45_000
    assert rows.select("row_no").distinct().count() == 45_000
