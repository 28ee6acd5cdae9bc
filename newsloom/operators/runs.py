"""Runs of words, and how many texts of a corpus hold them, without counting those of rare words.

A text of w words has w runs of each length, and nearly all of them are in one text only. Of all
of these none is sent that cannot be among a corpus' most frequent:

1. Words are counted by texts.
2. Pairs of a corpus' most frequent words are counted. The count of the ``enough``-th pair is the
   bound of its corpus: as many runs are at least as frequent. A corpus with fewer pairs has
   the least count asked for as its bound.
3. A run in as many texts as the bound has only words in as many texts. Other words end a run.

Counts are exact. Words pass by a table of bits, of fixed size for any number of corpora and words: words
that share a bit with a frequent one pass too, which costs work and changes no count.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from newsloom.session import stored

#: Bits of a table of words: 4 MB.
BITS = 1 << 25
#: Bits in a value of Spark's bitmap functions.
BUCKET = 1 << 15


def marks(found: DataFrame) -> bytes:
    """A bit for each ``(corpus_key, run)``, at its hash."""
    at = F.xxhash64("corpus_key", "run").bitwiseAND(F.lit(BITS - 1)) + 1
    buckets = (
        found.select(at.alias("at"))
        .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    )
    table = bytearray(BITS // 8)
    for row in buckets.toLocalIterator():
        table[(row["bucket"] - 1) * BUCKET // 8 : row["bucket"] * BUCKET // 8] = row["bits"]
    return bytes(table)


def _marked(words: pa.Array, seeds, kept: bytes):
    """Whether the bit of each word is set; seeds are the hashes of their corpora."""
    import numpy as np
    import xxhash

    pairs = zip(words.cast(pa.binary()).to_pylist(), seeds.tolist())
    at = np.fromiter((xxhash.xxh64_intdigest(w, s) for w, s in pairs), np.uint64, len(words)) & np.uint64(BITS - 1)
    return (np.frombuffer(kept, np.uint8)[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _counts(batch: pa.RecordBatch, sizes: Sequence[int], kept: bytes | None) -> Iterator[pa.RecordBatch]:
    """``(corpus_key, run, n)``: runs in the texts of a batch. Runs are numbered by their first part and last word."""
    import numpy as np
    import pyarrow.compute as pc

    said = batch.column("said")
    coded = said.flatten().dictionary_encode()
    names, ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    if not len(ids):
        return
    corpora = batch.column("corpus_key").dictionary_encode(null_encoding="encode")
    corpus = corpora.indices.to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(said)), pc.list_value_length(said).to_numpy(zero_copy_only=False))
    place = np.arange(len(ids))
    if kept is not None:
        seeds = np.zeros(len(corpora.dictionary), np.uint64)
        seeds[corpus] = batch.column("seed").to_numpy().view(np.uint64)
        words, which = np.unique(corpus[row] * len(names) + ids, return_inverse=True)
        good = _marked(names.take(pa.array(words % len(names))), seeds[words // len(names)], kept)[which]
        ids, row, place = ids[good], row[good], place[good]
    starts, codes = np.arange(len(ids)), 0
    for size in range(1, max(sizes) + 1):
        last = starts + size - 1
        whole = last < len(ids)
        whole[whole] = (row[last[whole]] == row[starts[whole]]) & (place[last[whole]] - place[starts[whole]] == size - 1)
        starts, last = starts[whole], last[whole]
        if not len(starts):
            return
        numbers = ids if size == 1 else codes[whole] * len(names) + ids[last]
        _, first, codes = np.unique(numbers, return_index=True, return_inverse=True)
        if size in sizes:
            held = np.unique(row[starts] * len(first) + codes)
            keys, n = np.unique(corpus[held // len(first)] * len(first) + held % len(first), return_counts=True)
            at = starts[first[keys % len(first)]]
            parts = [names.take(pa.array(ids[at + k])) for k in range(size)]
            run = pc.binary_join_element_wise(*parts, " ") if size > 1 else parts[0]
            columns = [corpora.dictionary.take(pa.array(keys // len(first))), run, pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["corpus_key", "run", "n"])


def counted(spoken: DataFrame, sizes: Sequence[int], kept: bytes | None = None) -> DataFrame:
    """``(corpus_key, run, texts)`` of ``(corpus_key, said)``, a row per text: runs of these lengths.

    With ``kept``, as ``marks`` gives it, only runs of marked words. Counts are folded in a batch, in a task and
    then in the shuffle.
    """
    kinds = [StructField("corpus_key", spoken.schema["corpus_key"].dataType), StructField("run", StringType()), StructField("n", LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _counts(batch, sizes, kept)

    rows = spoken.select("corpus_key", F.xxhash64("corpus_key").alias("seed"), "said")
    return rows.mapInArrow(run, StructType(kinds)).groupBy("corpus_key", "run").agg(F.sum("n").alias("texts"))


def frequent(spoken: DataFrame, least_texts: int, enough: int) -> bytes:
    """Marks the words of all runs that ``least_texts`` texts hold and that are as frequent as their
    corpus' bound: ``enough`` pairs of words are, or its bound is ``least_texts``."""
    said = stored(counted(spoken, [1]).where(F.col("texts") >= least_texts), "said")
    place = F.row_number().over(Window.partitionBy("corpus_key").orderBy(F.col("texts").desc(), "run"))
    pairs = counted(spoken, [2], marks(said.withColumn("place", place).where(F.col("place") <= 2 * enough)))
    bounds = pairs.withColumn("place", place).where(F.col("place") == enough).select(
        F.col("corpus_key").alias("bounded"), F.col("texts").alias("bound")
    )
    mine = F.col("corpus_key").eqNullSafe(F.col("bounded"))
    return marks(said.join(bounds, mine, "left").where(F.col("bound").isNull() | (F.col("texts") >= F.col("bound"))))
