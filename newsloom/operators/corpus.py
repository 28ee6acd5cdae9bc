"""Corpora as tables of texts, and their division into blocks.

A corpus is all texts of one key in file-name order with a blank line between
them. It is never put together in one value: it stays one row per file.

Where a block begins depends on where the one before began, so the division
is sequential within a corpus, and one corpus may hold a third of all rows. It
is done on line lengths alone, as a prefix scan over range partitions:

1. each file gives one narrow row: the lengths of its lines and its blank ends; these
   rows are range-partitioned by (corpus, file), so that a partition is a run of
   whole files in order;
2. each partition tells how it changes the size of the block it is entered
   with (at most one short summary per partition);
3. the summaries, in order, give the size each partition is entered with;
4. each partition numbers its lines, and the texts are cut by those numbers.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.fixed_values import BLOCK_CHARS
from newsloom.functions.cleaning import LINE_BREAK, clean_text, lines, strip, strip_left, strip_right
from newsloom.operators.transcripts import clean_texts
from newsloom.session import shared_dir, stored

FILE = ["file_name", "high", "low"]
KEYS = ["corpus_key", *FILE]
SEED = 5


def _files(texts: DataFrame, clean_first: bool = False) -> DataFrame:
    """``(corpus_key, file_name, high, low, text)``: files of one name are told apart by text.

    A row that is there twice is one file; a null text is empty.
    """
    text = F.coalesce("text", F.lit(""))
    rows = texts.select(
        F.col("corpus_key").cast("string"),
        "file_name",
        (clean_text(text) if clean_first else text).alias("text"),
    )
    digest = {"high": F.xxhash64("text"), "low": F.xxhash64(F.lit(SEED), "text")}
    return rows.withColumns(digest).select(*KEYS, "text")


def _ends(spoken: DataFrame) -> DataFrame:
    """The first and the last file of each corpus that is not blank, stored: its size is then known."""
    file = F.struct(*FILE)
    ends = spoken.groupBy("corpus_key").agg(F.min(file).alias("_begin"), F.max(file).alias("_end"))
    return stored(ends, "ends")


def _within(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Files from the first to the last one that is not blank, with ``first`` and ``last``."""
    file = F.struct(*FILE)
    return (
        rows.join(ends, "corpus_key")
        .where((file >= F.col("_begin")) & (file <= F.col("_end")))
        .withColumns({"first": file == F.col("_begin"), "last": file == F.col("_end")})
        .drop("_begin", "_end")
    )


def _share(text: Column, first: Column, last: Column) -> Column:
    """A file's share of its corpus: a blank line behind it, or the corpus's stripped end."""
    closed = F.when(last, strip_right(text)).otherwise(F.concat(text, F.lit("\n\n")))
    return F.when(first, strip_left(closed)).otherwise(closed)


def corpus_texts(texts: DataFrame, clean_first: bool = False) -> DataFrame:
    """Each file's share of its corpus: ``(corpus_key, file_name, high, low, text)``.

    The texts of a key, put end to end by file name (files of one name by digest), are the
    joined and stripped corpus. Files before the first and after the last text that is
    not blank fall away; a key with nothing but blanks has no row.
    """
    rows = _files(texts, clean_first).dropDuplicates(KEYS)
    spoken = rows.where(strip(F.col("text")) != "").select(*KEYS)
    kept = _within(rows, _ends(spoken))
    return kept.select(*KEYS, _share(F.col("text"), F.col("first"), F.col("last")).alias("text"))


def corpus_lines(texts: DataFrame, clean_first: bool = False) -> DataFrame:
    """``(corpus_key, file_name, line_no, text)``, blank lines between files included."""
    return corpus_texts(texts, clean_first).select(
        "corpus_key", "file_name", F.posexplode(lines(F.col("text"))).alias("line_no", "text")
    )


# ---- step 1: what the scan needs of each file -------------------------------


def file_lines(texts: DataFrame, clean_first: bool = False) -> DataFrame:
    """One narrow row per file: the lengths of its lines, and what stripping would take away.

    ``lengths`` are those of the text and the blank line behind it; ``blank_lines`` and
    ``blank_chars`` stand before its first character; without the blanks at
    its end it has ``n_lines`` lines, the last one ``last_chars`` long. No text is kept.
    """
    text = F.col("text")
    files = _files(texts, clean_first)
    n_blank = F.length(text) - F.length(strip_left(text))
    bare = strip_right(text)
    # What is in front of the first character and behind the last one: short, and cut at its breaks.
    lead = F.split(F.concat(F.substring(text, F.lit(1), n_blank), F.lit("x")), LINE_BREAK, -1)
    tail = F.concat(F.lit("x"), F.substring(text, F.length(bare) + 1, F.length(text)), F.lit("\n\n"))
    tail = F.split(tail, LINE_BREAK, -1)
    ends = F.struct(
        F.transform(lines(F.concat(text, F.lit("\n\n"))), lambda t: F.length(t)).alias("lengths"),
        (F.size(lead) - 1).alias("blank_lines"),
        (F.length(F.element_at(lead, -1)) - 1).alias("blank_chars"),
        # Breaks behind the last character, and blanks before the first of them.
        (F.size(tail) - 1).alias("breaks"),
        (F.length(F.get(tail, F.lit(0))) - 1).alias("tail_chars"),
        (bare == "").alias("blank"),
    )

    def narrow(e: Column) -> Column:
        n_lines = F.when(e["blank"], 0).otherwise(F.size(e["lengths"]) - e["breaks"] + 1)
        return F.struct(
            e["lengths"].alias("lengths"),
            e["blank_lines"].alias("blank_lines"),
            e["blank_chars"].alias("blank_chars"),
            n_lines.alias("n_lines"),
            (F.get(e["lengths"], n_lines - 1) - e["tail_chars"]).alias("last_chars"),
        )

    # In a lambda, so that a text is split once for all five.
    one = F.get(F.transform(F.array(ends), narrow), F.lit(0))
    return files.select(*KEYS, one.alias("_file")).select(*KEYS, "_file.*").dropDuplicates(KEYS)


def _line_lengths() -> Column:
    """Lengths of the lines of a file's share, without its text."""
    lengths = F.col("lengths")
    closed = F.when(
        F.col("last"),
        F.concat(F.slice(lengths, F.lit(1), F.col("n_lines") - 1), F.array("last_chars")),
    ).otherwise(lengths)
    lead = F.col("blank_lines")

    def without_lead(rest: Column) -> Column:
        return F.concat(
            F.array(F.get(rest, F.lit(0)) - F.col("blank_chars")), F.slice(rest, F.lit(2), F.size(rest))
        )

    begun = F.transform(F.array(F.slice(closed, lead + 1, F.size(closed))), without_lead)
    return F.when(F.col("first"), F.get(begun, F.lit(0))).otherwise(closed)


# ---- steps 2 to 4: the scan over line lengths ----------------------------
# An open block is known by its size in characters; None means none is open.


def _first_over(prefix: list[int], room: int) -> int:
    """The first line that does not fit into ``room`` characters."""
    return max(0, bisect_right(prefix, room) - 1)


def _openings_from(prefix: list[int], at: int, limit: int) -> tuple[list[int], int]:
    """Lines that open a block when line ``at`` opens one, and the last block's size."""
    n = len(prefix) - 1
    found = []
    while at < n:
        found.append(at)
        at = max(at + 1, _first_over(prefix, prefix[at] + limit))
    return found, prefix[n] - prefix[found[-1]]


def _openings(prefix: list[int], size: int | None, limit: int) -> tuple[list[int], int | None]:
    """The same for lines entered with an open block of ``size``."""
    n = len(prefix) - 1
    if n == 0:
        return [], size
    at = 0 if size is None else _first_over(prefix, limit - size)
    if at == n:
        return [], size + prefix[n]
    return _openings_from(prefix, at, limit)


def _prefix(rows: pd.DataFrame) -> list[int]:
    """Characters before each line of the files, one after the other, and in all."""
    lengths = np.concatenate(rows["line_lengths"].to_list()).astype(np.int64)
    return [0, *np.cumsum(lengths).tolist()]


class _Passage:
    """What a run of lines does to every size it may be entered with.

    Entry sizes that break at the same line share their fate from there on, so
    it is kept per class ``[low, high, size, opened]``: few classes, and fewer
    as they meet at the same line. Only a corpus the partition begins with can
    be entered with an open block; of others the fresh start is kept alone.
    """

    def __init__(self, limit: int, entered: bool):
        self.limit = limit
        self.entered = entered
        self.total = 0
        self.classes: list[list] = []
        self.fresh: tuple[int | None, int] = (None, 0)

    def add(self, prefix: list[int]) -> None:
        walked: dict[int | None, tuple[int, int | None]] = {}

        def walk(size: int | None) -> tuple[int, int | None]:
            if size not in walked:
                found, left = _openings(prefix, size, self.limit)
                walked[size] = (len(found), left)
            return walked[size]

        for item in self.classes:
            opened, item[2] = walk(item[2])
            item[3] += opened
        # Entry sizes not broken so far: one class per line that breaks some of them.
        high = None if self.total == 0 and not self.classes else self.limit - self.total
        at = 0
        while self.entered and at < len(prefix) - 1 and (high is None or high >= 0):
            low = max(0, self.limit - self.total - prefix[at + 1] + 1)
            if high is None or low <= high:
                found, left = _openings_from(prefix, at, self.limit)
                self.classes.append([low, high, left, len(found)])
                high = low - 1
            at += 1
        self.total += prefix[-1]
        opened, left = walk(self.fresh[0])
        self.fresh = (left, self.fresh[1] + opened)


_SUMMARY = (
    "part int, head string, tail string, total bigint, tail_size bigint, tail_blocks bigint, "
    "low array<bigint>, high array<bigint>, size array<bigint>, opened array<bigint>"
)
_OVER = 2**62


def _runs(batches: Iterator[pd.DataFrame]):
    """(part, corpus_key, rows) for every stretch of one corpus, in order."""
    for batch in batches:
        keys = batch["corpus_key"]
        change = (keys != keys.shift()).cumsum()
        for _, rows in batch.groupby(change, sort=False):
            yield int(rows["part"].iloc[0]), rows["corpus_key"].iloc[0], rows


def _summarise(limit: int):
    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head = tail = None
        part = 0
        passage = None
        for part, key, rows in _runs(batches):
            if key != tail:
                head = key if head is None else head
                tail, passage = key, _Passage(limit, key == head)
            passage.add(_prefix(rows))
        if passage is None:
            return
        single = passage.classes if head == tail else []
        columns = [list(c) for c in zip(*single)] if single else [[], [], [], []]
        columns[1] = [_OVER if high is None else high for high in columns[1]]
        left, blocks = passage.fresh
        row = [part, head, tail, passage.total, left, blocks, *columns]
        names = [field.split()[0] for field in _SUMMARY.split(", ")]
        yield pd.DataFrame([row], columns=names)

    return summarise


def _enter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The block open at the start of every partition, from the summaries in order."""
    key, size, block_no = None, None, 0
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            if row.head != key:
                size, block_no = None, 0
            out.append([row.part, row.head, size, block_no])
            if row.head != row.tail or size is None:
                before = block_no if row.head == row.tail else 0
                size, block_no = row.tail_size, before + row.tail_blocks
            else:
                for low, high, left, opened in zip(row.low, row.high, row.size, row.opened):
                    if low <= size <= high:
                        size, block_no = left, block_no + opened
                        break
                else:
                    size += row.total
            size, block_no, key = int(size), int(block_no), row.tail
        frame = pd.DataFrame(out, columns=["part", "head", "size", "block_no"])
        yield frame.astype({"size": "Int64"})


def _number(limit: int):
    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, size, block_no = None, None, 0
        started = False
        for _, run_key, rows in _runs(batches):
            if not started or run_key != key:
                size, block_no = None, 0
                if not started and rows["head"].iloc[0] == run_key:
                    entry = rows["size"].iloc[0]
                    size = None if pd.isna(entry) else int(entry)
                    block_no = int(rows["block_no"].iloc[0])
                key, started = run_key, True
            found, size = _openings(_prefix(rows), size, limit)
            out = []
            start = 0
            files = rows[[*FILE, "first", "last"]].itertuples(index=False)
            for file, line_lengths in zip(files, rows["line_lengths"]):
                end = start + len(line_lengths)
                low, high = bisect_left(found, start), bisect_left(found, end)
                # The file's first lines go on with the block open so far, if any do.
                marks = found[low:high]
                if end > start and (not marks or marks[0] > start):
                    marks, low = [start, *marks], low - 1
                pieces = [
                    {"block_no": block_no + low + 1 + i, "first": a - start, "lines": b - a}
                    for i, (a, b) in enumerate(zip(marks, [*marks[1:], end]))
                ]
                out.append([run_key, *file, pieces])
                start = end
            block_no += len(found)
            yield pd.DataFrame(out, columns=[*KEYS, "first", "last", "pieces"])

    return number


def block_pieces(
    files: DataFrame, max_chars: int = BLOCK_CHARS, partitions: int | None = None
) -> DataFrame:
    """Which lines of each file of ``file_lines`` go into which block."""
    spark = files.sparkSession
    shared_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = _within(files, _ends(files.where("n_lines > 0")))
    narrow = kept.select(*KEYS, "first", "last", _line_lengths().alias("line_lengths"))
    # Stored, as both passes need the same partitions; the range partitioning samples a table.
    lengths = (
        narrow.repartitionByRange(n, *KEYS)
        .sortWithinPartitions(*KEYS)
        .select(F.spark_partition_id().alias("part"), "*")
        .checkpoint()
    )
    # At most one row per partition, whatever the data.
    summaries = lengths.mapInPandas(_summarise(max_chars), _SUMMARY)
    entries = (
        summaries.repartition(1)
        .sortWithinPartitions("part")
        .mapInPandas(_enter, "part int, head string, size bigint, block_no bigint")
    )
    return lengths.join(F.broadcast(entries), "part").mapInPandas(
        _number(max_chars),
        "corpus_key string, file_name string, high bigint, low bigint, first boolean, last boolean, "
        "pieces array<struct<block_no:bigint,first:int,lines:int>>",
    )


def blocks(
    texts: DataFrame,
    max_chars: int = BLOCK_CHARS,
    clean_first: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """``(corpus_key, block_no, text)``: lines in order, a new block when the next line
    would make it longer than ``max_chars``; a longer line is a block of its own.

    Files of one name in a corpus follow one another by digest; a row that is there twice is
    one file. Texts are read twice: for ``file_lines``, and to be cut. In between they
    are known by their digests, so no text is shuffled by its corpus.
    """
    if clean_first:
        texts = stored(clean_texts(texts.select("corpus_key", "file_name", "text")), "clean")
    narrow = stored(file_lines(texts), "lines")
    pieces = block_pieces(narrow, max_chars, partitions)
    share = lines(_share(F.col("text"), F.col("first"), F.col("last")))
    cut = F.get(
        F.transform(
            F.array(share),
            lambda every: F.transform(
                F.col("pieces"),
                lambda p: F.struct(
                    p["block_no"].alias("block_no"),
                    F.array_join(F.slice(every, p["first"] + 1, p["lines"]), "\n").alias("text"),
                ),
            ),
        ),
        F.lit(0),
    )
    parts = _files(texts).join(pieces, KEYS).select(*KEYS, F.inline(cut).alias("block_no", "text"))
    # A set, so that a file that is there twice counts once; it has one piece in a block.
    piece = F.struct(*FILE, "text")
    ordered = F.transform(F.array_sort(F.collect_set(piece)), lambda p: p["text"])
    return parts.groupBy("corpus_key", "block_no").agg(F.array_join(ordered, "\n").alias("text"))
