"""Token ids in binary segments with Elias-Fano document boundaries.

A segment holds whole documents in order. Its bytes:

    header      magic, width of an id in bytes, number of documents, of ids,
                of null document ids, least document id
    boundaries  Elias-Fano: first id of each document and the end of the last
    documents   Elias-Fano: document ids less the least one
    ids         the concatenated ids, little-endian

Elias-Fano keeps the low bits of each value packed and marks the high parts in
a bit vector, some 2 + log2(mean gap) bits a value; positions of every 256th
mark are kept, so one value is found without reading the others.

Segments are rows of a Parquet table in the shared folder, so any file system
that Spark writes to can hold them; ``export`` writes them as plain files.
"""

from __future__ import annotations

import struct
import sys
from array import array
from collections.abc import Iterator
from operator import attrgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsloom.llm.chunks import cut, spelled
from newsloom.llm.common import Remembered, texts, worker_memo

HEADER = "<4sBqqqq"
MAGIC = b"NLT1"
SAMPLE = 256
#: Ids after which a segment ends; a longer document has a segment of its own.
SEGMENT_IDS = 2_000_000
#: Encoded parts and pieces that a worker remembers, twice.
REMEMBERED = 200_000
ID = attrgetter("id")


class EliasFano:
    """Values that never fall, from 0 up."""

    HEAD = "<qBqq"

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        import numpy as np

        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        self.samples = np.frombuffer(samples, "<u4")

    @classmethod
    def of(cls, values) -> EliasFano:
        import numpy as np

        v = np.asarray(values, dtype=np.int64)
        n = len(v)
        bits = max(0, (int(v[-1]) // n).bit_length() - 1) if n else 0
        low = b""
        if n and bits:
            shifts = np.arange(bits, dtype=np.int64)
            low = np.packbits(((v[:, None] >> shifts) & 1).astype(np.uint8).ravel(), bitorder="little").tobytes()
        marks = (v >> bits) + np.arange(n)
        flags = np.zeros(int(marks[-1]) + 1 if n else 0, dtype=np.uint8)
        flags[marks] = 1
        high = np.packbits(flags, bitorder="little").tobytes()
        return cls(n, bits, low, high, marks[::SAMPLE].astype("<u4").tobytes())

    def all(self):
        import numpy as np

        marks = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.n]
        found = (marks - np.arange(self.n)) << self.low_bits
        if self.low_bits and self.n:
            flags = np.unpackbits(
                np.frombuffer(self.low, np.uint8), count=self.n * self.low_bits, bitorder="little"
            ).reshape(self.n, self.low_bits)
            found = found + (flags.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)
        return found

    def select(self, i: int) -> int:
        """The i-th value alone."""
        import numpy as np

        if not 0 <= i < self.n:
            raise IndexError(i)
        start = int(self.samples[i // SAMPLE])
        left, byte = i % SAMPLE, start // 8
        # Marks before the sampled one in its byte do not count.
        current = self.high[byte] & (0xFF << (start % 8)) & 0xFF
        while left >= (ones := current.bit_count()):
            left -= ones
            byte += 1
            current = self.high[byte]
        mark = byte * 8 + int(np.flatnonzero([(current >> k) & 1 for k in range(8)])[left])
        value = (mark - i) << self.low_bits
        first = i * self.low_bits
        for k in range(self.low_bits):
            at = first + k
            value |= (self.low[at // 8] >> (at % 8) & 1) << k
        return value

    def to_bytes(self) -> bytes:
        head = struct.pack(self.HEAD, self.n, self.low_bits, len(self.low), len(self.high))
        return head + self.low + self.high + self.samples.tobytes()

    @classmethod
    def read(cls, data: bytes, at: int) -> tuple[EliasFano, int]:
        n, bits, lows, highs = struct.unpack_from(cls.HEAD, data, at)
        at += struct.calcsize(cls.HEAD)
        samples = 4 * -(-n // SAMPLE)
        cuts = [at, at + lows, at + lows + highs, at + lows + highs + samples]
        low, high, sample = (data[a:b] for a, b in zip(cuts, cuts[1:]))
        return cls(n, bits, low, high, sample), cuts[-1]


def write_segment(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """Documents with null ids come first."""
    import numpy as np

    known = [i for i in doc_ids if i is not None]
    least = known[0] if known else 0
    ends = np.cumsum([0, *(len(v) // width for v in ids)])
    head = struct.pack(HEADER, MAGIC, width, len(doc_ids), int(ends[-1]), len(doc_ids) - len(known), least)
    return b"".join(
        [
            head,
            EliasFano.of(ends).to_bytes(),
            EliasFano.of([i - least for i in known]).to_bytes(),
            *ids,
        ]
    )


class Segment:
    """Reading side of ``write_segment``."""

    def __init__(self, data: bytes):
        import numpy as np

        magic, width, self.n_docs, self.n_ids, self.nulls, self.least = struct.unpack_from(HEADER, data)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        self.bounds, at = EliasFano.read(data, struct.calcsize(HEADER))
        self.documents, at = EliasFano.read(data, at)
        self.ids = np.frombuffer(data, f"<u{width}", self.n_ids, at)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + (self.documents.all() + self.least).tolist()

    def document(self, i: int):
        """Ids of the i-th document, by two selects."""
        return self.ids[self.bounds.select(i) : self.bounds.select(i + 1)]


class Encoder:
    """A byte-level tokenizer file, with a memory of what it gave for a part of a text.

    The pieces of a part, split as byte-level BPE does, go to the library's model;
    with ``added``, a text that holds an added token goes to the library whole.
    """

    def __init__(self, path: str, pattern: str, added: bool = True):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 65536 else 4
        self.split = regex.compile(
            pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        )
        # Byte-level vocabularies spell a byte as itself if it prints, else as the next character from 256 up.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.spelling = {b: 256 + k for k, b in enumerate(hidden)}
        self.space = chr(self.spelling[32])
        self.kind = "H" if self.width == 2 else "I"
        self.tokenize = self.tokenizer.model.tokenize
        tokens = self.tokenizer.get_added_tokens_decoder().values() if added else ()
        #: Where an added token may stand; with a normalizer it may arise anywhere.
        self.added = regex.compile("|".join(regex.escape(t.content) for t in tokens) or r"(?!)")
        self.whole = self.tokenizer.normalizer is not None and any(t.normalized for t in tokens)
        self.pieces = Remembered(self._encode_piece, REMEMBERED)
        self.parts = Remembered(self._encode_cut, REMEMBERED)

    def _encode_piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            return self._encode_shown(piece.replace(" ", self.space))
        return self._encode_shown(piece.encode().decode("latin-1").translate(self.spelling))

    def _encode_shown(self, shown: str) -> bytes:
        ids = array(self.kind, map(ID, self.tokenize(shown)))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _encode_cut(self, part: str) -> bytes:
        if part.isalpha():
            # A piece of its own, so remembered as a part alone.
            return self._encode_shown(self.space + part) if part.isascii() else self._encode_piece(" " + part)
        if part[-1] in ".," and part[-2:-1].isalpha():
            return self.parts[part[:-1]] + self.pieces[part[-1]]
        return self._encode_part(spelled(part))

    def _encode_part(self, part: str) -> bytes:
        return b"".join([self.pieces[piece] for piece in self.split.findall(part)])

    def _encode_whole(self, text: str) -> bytes:
        ids = array(self.kind, self.tokenizer.encode(text, add_special_tokens=False).ids)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def encode(self, text: str) -> bytes:
        if self.whole or self.added.search(text):
            return self._encode_whole(text)
        first, rest = cut(text)
        return self._encode_part(first) + b"".join(map(self.parts.__getitem__, rest))


def write_tokens(
    docs: DataFrame, tokenizer_path: str, pattern: str, end_id: int, path: str, added_tokens: bool = False
) -> None:
    """Write (doc_id, text) as segments below ``path``, in ascending doc_id order.

    Rows are dealt out by ranges of doc_id and sorted, so a segment continues
    the one before. Null texts are empty; rows with a null id come first; rows
    that share an id are ordered by their text. An empty table gives no segment.
    Strings of added tokens in a text are ordinary text, or with ``added_tokens``
    have the tokens' ids, as the library has it by default.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = worker_memo(
            ("tokenizers", tokenizer_path, pattern, added_tokens), lambda: Encoder(tokenizer_path, pattern, added_tokens)
        )
        end = end_id.to_bytes(encoder.width, "little")
        part, number = TaskContext.get().partitionId(), 0
        doc_ids, ids, size = [], [], 0

        def segment() -> pa.RecordBatch:
            data = write_segment(doc_ids, ids, encoder.width)
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int64()),
                    "segment": pa.array([number], pa.int64()),
                    "n_ids": pa.array([size], pa.int64()),
                    "data": pa.array([data], pa.binary()),
                }
            )

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch, "text")):
                doc_ids.append(doc_id)
                ids.append(encoder.encode(text) + end)
                size += len(ids[-1]) // encoder.width
                if size >= SEGMENT_IDS:
                    yield segment()
                    doc_ids, ids, size, number = [], [], 0, number + 1
        if doc_ids:
            yield segment()

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .repartitionByRange(n, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(run, "part long, segment long, n_ids long, data binary")
        .write.parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the segments: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before. Only one row per segment
    is summed up in order; ids stay where they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        import numpy as np

        for batch in batches:
            for part, number, data in zip(*(batch.column(c).to_pylist() for c in ("part", "segment", "data"))):
                found = Segment(data)
                bounds = found.bounds.all()
                ids = found.ids.astype("<u4").tobytes()
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * found.n_docs, pa.int64()),
                        pa.array([number] * found.n_docs, pa.int64()),
                        pa.array(found.doc_ids(), pa.int64()),
                        pa.array(bounds[:-1], pa.int64()),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["part", "segment", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    schema = "part long, segment long, n_ids long, data binary"
    segments = spark.read.schema(schema).parquet(path)
    before = W.orderBy("part", "segment").rowsBetween(W.unboundedPreceding, -1)
    starts = segments.select(
        "part", "segment", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before")
    )
    return (
        segments.select("part", "segment", "data")
        .mapInArrow(run, "part long, segment long, doc_id long, inside long, n_tokens long, ids_crc32 long")
        .join(starts, ["part", "segment"])
        .select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )


def export(spark: SparkSession, path: str, folder: str) -> None:
    """Write the segments as plain files into a folder that all executors see."""

    def run(row) -> None:
        with open(f"{folder}/{row.part:06d}-{row.segment:06d}.tok", "wb") as out:
            out.write(row.data)

    spark.read.parquet(path).select("part", "segment", "data").foreach(run)
