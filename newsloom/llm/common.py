"""What several operators share: table reading, worker-wide memory, sorted runs."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a whole table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def worker_memo(key: tuple, build: Callable):
    """A value that tasks of one Python worker share, such as a loaded vocabulary.

    Functions travel by value, so their modules' globals last for one task only.
    """
    holder = sys.modules.setdefault("_newsloom_worker_memo", types.ModuleType("memo"))
    memo = holder.__dict__.setdefault("values", {})
    if key not in memo:
        memo[key] = build()
    return memo[key]


class Remembered(dict):
    """Results of a function by key: the latest, and those of the time before."""

    def __init__(self, build: Callable, size: int):
        super().__init__()
        self.build, self.size, self.older = build, size, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.build(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


def binaries(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a text column; null counts as empty."""
    return [v or b"" for v in batch.column(column).cast(pa.binary()).to_pylist()]


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """A text column; null counts as empty."""
    return [v or "" for v in batch.column(column).to_pylist()]


def give_back() -> None:
    """Memory that is free goes back to the system; allocators keep it, and idle processes with them."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def tidy(run: Callable) -> Callable:
    """A task's function that gives free memory back at its end: its process waits beside others for the next task."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return tidied


def hashed(words: list[bytes]):
    """64-bit hashes of words. Nothing is remembered: a look-up costs more than a hash, and its table much memory."""
    import numpy as np
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of rows with equal keys, from batches that are sorted by these keys.

    Holds one run and one batch; callers see to it that runs are bounded.
    """
    import numpy as np
    import pyarrow.compute as pc

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(max(batch.num_rows - 1, 0), dtype=bool)
        for key in keys:
            column = batch.column(batch.schema.get_field_index(key))
            changed |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(
                zero_copy_only=False
            )
        starts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            piece = batch.slice(a, b - a)
            value = tuple(piece.column(piece.schema.get_field_index(k))[0].as_py() for k in keys)
            if held and value != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(piece)
            last = value
    if held:
        yield pa.Table.from_batches(held)
