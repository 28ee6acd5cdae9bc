"""Benchmark passages in documents, by a positional inverted index.

The index is cut by documents: a shard holds whole documents, and for each word
in them the sorted positions where it stands. It is written once, whatever the
benchmark. A search takes the words of a benchmark window, begins with the one
that is rarest in the shard, shifts each list of positions by the word's place
in the window, and intersects them. What is left after the last word are
places of the exact phrase; with a tolerance around each place, proximity matches.

Words stand in the index as 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import binaries, hashed, tidy
from newsloom.session import stored

WINDOW = 13
#: Places a word may be away in a proximity match.
SLOP = 3
#: Words after which a shard ends; a longer document has a shard of its own.
SHARD_WORDS = 2_000_000
#: Characters of benchmark texts that a pass over the index searches at once.
BLOCK_CHARS = 20_000_000
#: Positions left free between documents, so that no match reaches the next one.
GAP = WINDOW + 2 * SLOP

#: A-Z become a-z; all other ASCII but 0-9 and a-z parts words.
FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

INDEX = "part long, shard long, doc_ids array<long>, starts binary, n_words binary, terms binary, offsets binary, positions binary"


def word_hashes(text: bytes):
    return hashed(text.translate(FOLDED).split())


def index(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> one row per shard, as in ``INDEX``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        doc_ids, found, size = [], [], 0

        def shard() -> pa.RecordBatch:
            lengths = np.array([len(f) for f in found], dtype=np.int64)
            starts = np.concatenate([[0], np.cumsum(lengths + GAP)[:-1]])
            words = np.concatenate(found)
            places = np.arange(len(words)) + np.repeat(GAP * np.arange(len(found)), lengths)
            order = np.argsort(words, kind="stable")
            terms, first = np.unique(words[order], return_index=True)
            row = {
                "part": part,
                "shard": number,
                "doc_ids": doc_ids,
                "starts": starts.astype("<i8").tobytes(),
                "n_words": lengths.astype("<i8").tobytes(),
                "terms": terms.astype("<u8").tobytes(),
                "offsets": np.append(first, len(words)).astype("<i8").tobytes(),
                "positions": places[order].astype("<u4").tobytes(),
            }
            kinds = pa.schema(
                [("part", pa.int64()), ("shard", pa.int64()), ("doc_ids", pa.list_(pa.int64()))]
                + [(k, pa.binary()) for k in ("starts", "n_words", "terms", "offsets", "positions")]
            )
            return pa.RecordBatch.from_pylist([row], kinds)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), binaries(batch, "text")):
                doc_ids.append(doc_id)
                found.append(word_hashes(text))
                size += len(found[-1])
                if size >= SHARD_WORDS:
                    yield shard()
                    doc_ids, found, size, number = [], [], 0, number + 1
        if doc_ids:
            yield shard()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidy(run), INDEX)


def windows(items: list[tuple]) -> tuple:
    """Distinct windows of (item_id, text) rows: hashes by length, items of each window."""
    import numpy as np

    owners = {}
    for item_id, text in items:
        words = word_hashes((text or "").encode())
        if not len(words):
            continue
        for a in range(max(1, len(words) - WINDOW + 1)):
            owners.setdefault(words[a : a + WINDOW].tobytes(), set()).add(str(item_id))
    by_length: dict[int, list[bytes]] = {}
    for window in owners:
        by_length.setdefault(len(window) // 8, []).append(window)
    return [
        (
            np.frombuffer(b"".join(some), np.uint64).reshape(len(some), length),
            [sorted(owners[w]) for w in some],
        )
        for length, some in sorted(by_length.items())
    ]


def _near(candidates, places, slop: int):
    """Which candidates have a place within the tolerance."""
    import numpy as np

    return np.searchsorted(places, candidates - slop) < np.searchsorted(places, candidates + slop, "right")


def _intersect(columns, window_no: int, lists: list, slop: int):
    """Starts at which each word of the window stands within the tolerance of its place."""
    import numpy as np

    order = sorted(range(len(lists)), key=lambda k: (len(lists[k]), k))
    first = order[0]
    candidates = lists[first].astype(np.int64) - first
    for k in order[1:]:
        if not len(candidates):
            break
        candidates = candidates[_near(candidates + k, lists[k], slop)]
    return candidates


def search(shards: DataFrame, items: list[tuple]) -> DataFrame:
    """Matches of some benchmark rows in an index; one row per document.

    Columns: part, shard, place (of the document in its shard), doc_id, n_words,
    hits (array of [from, to) word places that exact matches cover),
    item_ids (exact matches), near_item_ids (proximity matches), as strings.
    """
    sought = windows(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for row in batch.to_pylist():
                yield found_in(row, np)

    def found_in(row: dict, np) -> pa.RecordBatch:
        terms, offsets = np.frombuffer(row["terms"], "<u8"), np.frombuffer(row["offsets"], "<i8")
        positions = np.frombuffer(row["positions"], "<u4").astype(np.int64)
        starts, lengths = np.frombuffer(row["starts"], "<i8"), np.frombuffer(row["n_words"], "<i8")
        n = len(starts)
        size = int(starts[-1] + lengths[-1]) if n else 0
        covered = np.zeros(size + GAP + 1, dtype=np.int32)
        exact: list[set[str]] = [set() for _ in range(n)]
        near: list[set[str]] = [set() for _ in range(n)]
        for table, owners in sought if len(terms) else []:
            at = np.minimum(np.searchsorted(terms, table), len(terms) - 1)
            width = table.shape[1]
            for k in np.flatnonzero((terms[at] == table).all(axis=1)):
                lists = [positions[offsets[t] : offsets[t + 1]] for t in at[k]]
                close = _intersect(table, k, lists, SLOP)
                if not len(close):
                    continue
                for d in np.unique(np.searchsorted(starts, np.maximum(close, 0), "right") - 1):
                    near[d].update(owners[k])
                places = _intersect(table, k, lists, 0)
                np.add.at(covered, places, 1)
                np.add.at(covered, places + width, -1)
                for d in np.unique(np.searchsorted(starts, places, "right") - 1):
                    exact[d].update(owners[k])
        edges = np.diff(np.concatenate([[0], np.cumsum(covered) > 0, [0]]).astype(np.int8))
        lows, highs = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        hits: list[list[list[int]]] = [[] for _ in range(n)]
        for a, b, d in zip(lows.tolist(), highs.tolist(), (np.searchsorted(starts, lows, "right") - 1).tolist()):
            hits[d].append([a - int(starts[d]), b - int(starts[d])])
        strings = pa.list_(pa.string())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([row["part"]] * n, pa.int64()),
                pa.array([row["shard"]] * n, pa.int64()),
                pa.array(range(n), pa.int64()),
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(hits, pa.list_(pa.list_(pa.int64()))),
                pa.array([sorted(x) for x in exact], strings),
                pa.array([sorted(x) for x in near], strings),
            ],
            ["part", "shard", "place", "doc_id", "n_words", "hits", "item_ids", "near_item_ids"],
        )

    return shards.mapInArrow(
        tidy(run),
        "part long, shard long, place long, doc_id long, n_words long, hits array<array<long>>, "
        "item_ids array<string>, near_item_ids array<string>",
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text) and (item_id, text) -> matches, one row per document row.

    Columns: doc_id, n_words, hits, n_hit (words that exact matches cover),
    item_ids, near_item_ids, contaminated (n_hit > 0 and 20 * n_hit >= n_words).

    The benchmark is searched for in blocks of at most about ``BLOCK_CHARS``, so
    what goes to the executors is bounded whatever its size; results of blocks
    are merged per document. Null and empty texts have no words and no matches;
    a null item id reads "None"; repeated rows give repeated results.
    """
    shards = stored(index(docs), "index")
    size = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + size // BLOCK_CHARS
    found = None
    for b in range(blocks):
        some = benchmark.select("item_id", F.col("text").cast("string"))
        if blocks > 1:
            some = some.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        block = search(shards, [tuple(r) for r in some.toLocalIterator()])
        found = block if found is None else found.union(block)
    if blocks > 1:
        found = found.groupBy("part", "shard", "place", "doc_id", "n_words").agg(
            F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("near_item_ids")))).alias("near_item_ids"),
        )
    # Spans are sorted: each adds what lies beyond the furthest end so far.
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda s, h: F.struct(
            (s["n"] + F.greatest(F.lit(0), h[1] - F.greatest(s["end"], h[0]))).alias("n"),
            F.greatest(s["end"], h[1]).alias("end"),
        ),
    )["n"]
    return found.withColumn("n_hit", covered).select(
        "doc_id",
        "n_words",
        "hits",
        "n_hit",
        "item_ids",
        "near_item_ids",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
