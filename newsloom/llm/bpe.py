"""Byte-level BPE by backtracking from the longest matches.

Bytes are mapped to Latin-1 characters, so that an automaton over strings finds
all vocabulary entries in a piece. A sequence of tokens is what the merges give
exactly when each two adjacent tokens are what the merges give for their own
concatenation; whether they are is remembered per pair. The search takes the
longest entry that fits after the last token and steps back when none does; a
position that failed once is never tried again, so the time is linear.
"""

from __future__ import annotations

import base64
import struct
import sys
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.chunks import cut, spelled
from newsloom.llm.common import Remembered, texts, tidy, worker_memo

#: Encoded parts that a worker remembers, twice, and pairs of tokens it remembers.
REMEMBERED = 120_000
PAIRS = 200_000
#: No entry.
NONE = -1


def vocabulary(rank_file: str) -> list[tuple[bytes, int]]:
    """The entries of a rank file and their ids."""
    with open(rank_file, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return [(base64.b64decode(a), int(b)) for a, b in pairs]


class Bpe:
    def __init__(self, rank_file: str, pattern: str):
        import ahocorasick
        import regex

        self.ranks = {entry.decode("latin-1"): i for entry, i in vocabulary(rank_file)}
        # The pattern's white space is Unicode's; the module's \s has more.
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.automaton = ahocorasick.Automaton()
        for s, i in self.ranks.items():
            self.automaton.add_word(s, (len(s), i))
        self.automaton.make_automaton()
        #: Of each entry its length, and the longest other entry that it begins with.
        self.lengths = {i: len(s) for s, i in self.ranks.items()}
        self.shorter = {i: self._beginning(s) for s, i in self.ranks.items()} | {NONE: NONE}
        self.fits: dict[int, bool] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        for s, i in sorted(self.ranks.items(), key=lambda x: x[1]):
            self.halves[i] = self._last_merge(s, i)
            if self.halves[i]:
                self.merged[self.halves[i]] = i
        self.fits.clear()  # the table of merges was not complete yet
        self.parts = Remembered(self._encode_cut, REMEMBERED)

    def _beginning(self, s: str) -> int:
        return next((self.ranks[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in self.ranks), NONE)

    def _last_merge(self, s: str, rank: int) -> tuple[int, int] | None:
        """The two earlier tokens that this one is merged from."""
        for cut in range(len(s) - 1, 0, -1):
            a, b = self.ranks.get(s[:cut]), self.ranks.get(s[cut:])
            if a is not None and b is not None and a < rank and b < rank and self.compatible(a, b):
                return a, b
        return None

    def compatible(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > PAIRS:
                self.fits.clear()
            known = self.fits[key] = self._unmerged(a, b)
        return known

    def _unmerged(self, a: int, b: int) -> bool:
        """Would the merges leave the border between two tokens alone?

        Undo the merges of both sides, latest first. At each moment the tokens
        that touch the border must not merge before the side that is whole
        again would have.
        """
        before = float("inf")
        left, right = a, b
        while True:
            rank = self.merged.get((left, right))
            if rank is not None and rank < before:
                return False
            split_left, split_right = self.halves.get(left), self.halves.get(right)
            if split_left is None and split_right is None:
                return True
            # Of two merges with one rank the left one comes first, so the right one is undone first.
            if split_right is not None and (split_left is None or right >= left):
                before, right = right + 0.5, split_right[0]
            else:
                before, left = left, split_left[1]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the split pattern."""
        return self._encode_piece(piece.decode("latin-1"))

    def _encode_piece(self, s: str) -> list[int]:
        whole = self.ranks.get(s)
        if whole is not None:
            return [whole]
        if not s:
            return []
        longest, known, compatible = self.automaton.iter_long, self.fits.get, self.compatible
        ids, ends, failed = [], [0], set()
        at, before = 0, NONE
        matches = longest(s)
        while True:
            token = NONE
            for last, (length, token) in matches:
                end = last + 1
                if end - length != at:
                    token = NONE  # nothing begins here
                    break
                if end in failed:
                    break
                if before != NONE:
                    fits = known(before << 32 | token)
                    if not (compatible(before, token) if fits is None else fits):
                        break
                ids.append(token)
                ends.append(end)
                at, before = end, token
            else:
                if at == len(s):
                    return ids
                token = NONE
            # The longest entry does not fit here: a shorter one does, or else one at the step before.
            while True:
                token = self.shorter[token]
                if token == NONE:
                    if not ids:
                        raise ValueError("the vocabulary lacks single bytes")
                    failed.add(ends.pop())
                    token, at = ids.pop(), ends[-1]
                    before = ids[-1] if ids else NONE
                    continue
                end = at + self.lengths[token]
                if end not in failed and (before == NONE or compatible(before, token)):
                    break
            ids.append(token)
            ends.append(end)
            at, before = end, token
            matches = longest(s, end)

    def encode(self, text: str) -> list[int]:
        """Ids of a text, each match of the split pattern encoded alone."""
        packed = self.packed(text)
        return list(struct.unpack(f"<{len(packed) // 4}I", packed))

    def packed(self, text: str) -> bytes:
        """The ids as little-endian 32-bit integers; parts are remembered so, a fraction of what tuples take."""
        first, rest = cut(text)
        return self._encode_part(first) + b"".join(map(self.parts.__getitem__, rest))

    def _encode_cut(self, part: str) -> bytes:
        if part.isalpha():
            piece = " " + part
            return _pack(self._encode_piece(piece if part.isascii() else piece.encode().decode("latin-1")))
        if part[-1] in ".," and part[-2:-1].isalpha():
            return self.parts[part[:-1]] + _pack([self.ranks[part[-1]]])
        return self._encode_part(spelled(part))

    def _encode_part(self, part: str) -> bytes:
        return _pack([i for piece in self.split.findall(part) for i in self.encode_piece(piece.encode())])


def _pack(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def loaded(rank_file: str, pattern: str) -> Bpe:
    return worker_memo(("bpe", rank_file, pattern), lambda: Bpe(rank_file, pattern))


def entries(rank_file: str) -> list[bytes]:
    """The bytes of each id: all that decoding needs."""

    def build() -> list[bytes]:
        pairs = vocabulary(rank_file)
        found = [b""] * (max(i for _, i in pairs) + 1)
        for entry, i in pairs:
            found[i] = entry
        return found

    return worker_memo(("bpe entries", rank_file), build)


def encode(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """(doc_id, text) -> (doc_id, ids): the ids as little-endian 32-bit integers.

    A null text counts as empty and has no ids. Rows are independent of each
    other: repeated rows and null ids come out as they went in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(rank_file, pattern)
        for batch in batches:
            ids = [bpe.packed(t) for t in texts(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(tidy(run), "doc_id long, ids binary")


def decode(rows: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """(doc_id, ids) -> (doc_id, decoded): the bytes the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        bytes_of = entries(rank_file)
        for batch in batches:
            found = [
                b"".join(map(bytes_of.__getitem__, np.frombuffer(v or b"", "<u4").tolist()))
                for v in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "decoded"]
            )

    return rows.select("doc_id", "ids").mapInArrow(tidy(run), "doc_id long, decoded binary")


def round_trip(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """(doc_id, text) -> ids, and digests of the ids and of what they decode to.

    Decoding starts from the encoded ids alone, by the entries' bytes; it runs in the
    worker that encodes, so a task needs one Python process. Columns: doc_id, ids,
    n_tokens, ids_sha256 (decimal ids, one space between), decoded_sha256.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        bpe, bytes_of = loaded(rank_file, pattern), entries(rank_file)
        word, entry = list(map(str, range(len(bytes_of)))).__getitem__, bytes_of.__getitem__
        for batch in batches:
            packed, counts, hashes, back = [], [], [], []
            for text in texts(batch, "text"):
                packed.append(bpe.packed(text))
                ids = struct.unpack(f"<{len(packed[-1]) // 4}I", packed[-1])
                counts.append(len(ids))
                hashes.append(hashlib.sha256(" ".join(map(word, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(b"".join(map(entry, ids))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(packed, pa.binary()),
                    pa.array(counts, pa.int64()),
                    pa.array(hashes, pa.string()),
                    pa.array(back, pa.string()),
                ],
                ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(tidy(run), "doc_id long, ids binary, n_tokens long, ids_sha256 string, decoded_sha256 string")
