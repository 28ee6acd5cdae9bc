"""Lines that stand in many documents are taken out of all of them.

Lines are exploded in a normal form and hashed to 128 bits. A document gives each
of its hashes once, so a plain count of a hash, folded on the map side, is its number
of documents. Hashes over the threshold meet the lines again as (document, position,
hash), never as text; what is left of these is one list of positions per document,
and each text is put together from the stretches between them.

All of it is DataFrame functions. Texts are shuffled once, by a digest of the
row; lines travel as hashes only. A line that holds a third of all rows is
counted on the map side, and AQE splits it in the join.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import stored

BLANKS = "".join(map(chr, [0x20, *range(0x09, 0x0E)]))
LEAST_DOCUMENTS = 10
LEAST_CHARS = 1
SEED = 12


def lines(text: Column) -> Column:
    """The lines of a text; null and the empty text are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """Without blanks at both ends, A-Z in lower case."""
    return F.translate(
        F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase
    )


def _digest(*parts: Column) -> dict[str, Column]:
    """128 bits of a value, as two numbers."""
    return {"high": F.xxhash64(*parts), "low": F.xxhash64(F.lit(SEED), *parts)}


def _hashed(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(*keep, *[c.alias(n) for n, c in _digest(F.col("key")).items()])


def frequent_lines(
    texts: DataFrame, least_documents: int = LEAST_DOCUMENTS, least_chars: int = LEAST_CHARS
) -> DataFrame:
    """``(text)`` rows -> ``(high, low, documents)`` of line keys found in enough rows."""
    keys = F.array_distinct(F.transform(lines(F.col("text")), line_key))
    single = texts.select(F.explode(keys).alias("key")).where(F.length("key") >= least_chars)
    counts = _hashed(single).groupBy("high", "low").agg(F.count("*").alias("documents"))
    return counts.where(F.col("documents") >= least_documents)


def _kept(every: Column, dropped: Column) -> Column:
    """The lines between the dropped positions (ascending, from 0)."""
    before = F.concat(F.array(F.lit(-1)), dropped)
    after = F.concat(dropped, F.array(F.size(every)))
    return F.flatten(F.zip_with(before, after, lambda a, b: F.slice(every, a + 2, b - a - 1)))


def without_frequent_lines(
    documents: DataFrame, least_documents: int = LEAST_DOCUMENTS, least_chars: int = LEAST_CHARS
) -> DataFrame:
    """``(doc_id, text)`` -> one row per row: ``doc_id, text, n_lines, n_dropped``.

    A row is a document, also where its id is null or repeated; equal rows are as
    many documents. A text that is null or empty is one empty line. Keys shorter than
    ``least_chars`` (blank lines) are never dropped. A text all of whose lines go is
    empty. Ties there are none: a key is dropped everywhere or nowhere. Other
    columns are not read; an empty table gives no rows. A document's lines and
    positions are held in one row, so memory grows with the longest document alone.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    row = {f"row_{n}": c for n, c in _digest(F.col("doc_id"), F.col("text")).items()}
    keyed = rows.withColumns(row)
    placed = keyed.select(*row, F.posexplode(lines(F.col("text"))).alias("position", "line"))
    placed = placed.select(*row, "position", line_key(F.col("line")).alias("key"))
    placed = _hashed(placed.where(F.length("key") >= least_chars), *row, "position")
    # Written, so that its size is known: a small one is broadcast, and beyond that the join has
    # exchanges of its own, in which AQE deals a hot line to many tasks.
    frequent = stored(
        frequent_lines(rows, least_documents, least_chars).select("high", "low"), "frequent"
    )
    dropped = (
        placed.join(frequent, ["high", "low"], "left_semi")
        .groupBy(*row)
        # Equal rows give equal positions.
        .agg(F.array_sort(F.collect_set("position")).alias("dropped"))
    )
    none = F.array().cast("array<int>")
    found = keyed.join(dropped, list(row), "left").select(
        "doc_id",
        # Bound once each: an outer expression in a lambda would be worked out per call.
        F.transform(
            F.array(
                F.struct(
                    lines(F.col("text")).alias("lines"),
                    F.coalesce("dropped", none).alias("dropped"),
                )
            ),
            lambda d: F.struct(
                F.array_join(_kept(d["lines"], d["dropped"]), "\n").alias("text"),
                F.size(d["lines"]).cast("long").alias("n_lines"),
                F.size(d["dropped"]).cast("long").alias("n_dropped"),
            ),
        )[0].alias("found"),
    )
    return found.select("doc_id", "found.*")
