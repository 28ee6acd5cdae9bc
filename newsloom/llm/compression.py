"""Classifiers that compare compressed lengths under zstandard dictionaries.

Both learn from a bounded sample of labelled rows, drawn by a hash of the row's
id: ``SAMPLE`` rows of each class, half for the dictionaries, half for the
calibration of the score. Every text is then scored whole. Toxic segments are
counted by length, each length in a task of its own.

Toxicity. Windows of ``WINDOW`` characters slide over the whole text, ``STEP``
by ``STEP``, inside words and across them, so each run of up to 13 characters
stands whole in one. Segments are runs of characters of a few lengths. Both
dictionaries hold the most frequent segments of ordinary text; the toxic one
also all those that stand in toxic text in significantly more different contexts
(so that copies of a text count once), each up to ``DICTIONARY_BYTES``. The bytes
by which the toxic dictionary shortens a window more are its gain; a window
without a toxic segment has none and is not compressed. A calibrated function of
the numbers of windows by gain is the score. Characters are spelled as
three-byte codes, so that the cost of a match is small beside what it saves.

Quality. Dictionaries are trained on good and on bad texts. The difference of
the compressed sizes, by the size of the text, is calibrated together with the
two sizes themselves, which tell of text that repeats itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.common import Remembered, give_back, texts, tidy
from newsloom.session import stored

#: Labelled rows of each class that are learned from, at most.
SAMPLE = 4000
#: Characters of a window, and from one window's start to the next.
WINDOW, STEP = 16, 4
#: Lengths of segments; each is put together from two shorter ones.
SEGMENTS = {2: (1, 1), 3: (2, 1), 4: (2, 2), 5: (4, 1), 6: (4, 2), 8: (4, 4), 12: (8, 4)}
#: Bytes by which the toxic dictionary must shorten a window, for each count of hits.
GAINS = (1, 2, 4, 6, 8, 10, 12, 15)
#: A toxic segment is in so many texts at least, and so many times as frequent as in ordinary text.
LEAST_TEXTS, TYPICAL = 4, 10
#: Bits of the table that tells which positions may begin a toxic segment.
TABLE_BITS = 18
#: Bits of the table that tells in training which segments are too rare to count.
COUNT_BITS = 22
#: Positions that a task of the training sorts at once.
COUNTED = 1_000_000
#: Characters that are hashed at once.
STRETCH = 1 << 16
DICTIONARY_BYTES = 48_000
#: Bytes that are compressed at once.
BLOCK = 1 << 20
REMEMBERED = 300_000


def held_out():
    """Rows whose labels are never learned from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def sampled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, text, label, half) of at most ``SAMPLE`` rows per class; halves by hash."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & ~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    order = F.xxhash64("doc_id", F.lit(label))
    drawn = None
    for value in (0, 1):
        some = known.where(F.col("label") == value).orderBy(order, "doc_id").limit(SAMPLE)
        drawn = some if drawn is None else drawn.union(some)
    # At most 2 * SAMPLE narrow rows.
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(drawn), "doc_id")
    return rows.where("text IS NOT NULL").select(
        "doc_id", "text", "label", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).alias("half")
    )


def sample(docs: DataFrame, labels: DataFrame, label: str) -> list[tuple[str, int, int]]:
    """(text, label, half) of the sampled rows, in order."""
    found = sampled(docs, labels, label)
    return [(r["text"], r["label"], r["half"]) for r in sorted(found.collect(), key=lambda r: (r["doc_id"], r["text"]))]


def prior(labels: DataFrame, label: str) -> float:
    """Share of label 1 among all rows that may be learned from; without any, a quarter."""
    row = labels.where(F.col("doc_id").isNotNull() & ~held_out()).agg(
        F.sum((F.col(label) == 1).cast("int")).alias("one"), F.count(label).alias("all")
    ).first()
    return ((row["one"] or 0) + 0.5) / (row["all"] + 2)


def logistic(x, y, share: float, penalty: float) -> dict:
    """Ridge-penalised logistic regression on scaled features; classes weigh as in the whole corpus."""
    import numpy as np

    x, y = np.asarray(x, dtype=float), np.asarray(y, dtype=float)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    rows = np.c_[(x - mean) / scale, np.ones(len(x))]
    weight = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum()))
    w = np.zeros(rows.shape[1])
    ridge = penalty * np.eye(len(w))
    ridge[-1, -1] = 1e-9
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        bend = (rows * (weight * p * (1 - p))[:, None]).T @ rows + ridge
        step = np.linalg.solve(bend, rows.T @ (weight * (p - y)) + ridge @ w)
        w = w - step * min(1.0, 3 / (np.abs(step).max() + 1e-12))
    return {"mean": mean, "scale": scale, "weights": w}


def scores(model: dict, features):
    import numpy as np

    if not len(features):
        return np.zeros(0)
    rows = (np.asarray(features, dtype=float) - model["mean"]) / model["scale"]
    return 1 / (1 + np.exp(-np.clip(rows @ model["weights"][:-1] + model["weights"][-1], -30, 30)))


def _folded(text: str) -> str:
    """Lower case, each run of white space one blank, also at both ends."""
    return f" {' '.join(text.lower().split())} "


def _needed(*lengths: int) -> frozenset[int]:
    """These lengths and those that they are put together from."""
    found = set(lengths)
    for length in sorted(SEGMENTS, reverse=True):
        if length in found:
            found.update(SEGMENTS[length])
    return frozenset(found)


def _hashes(text: str, needed: frozenset[int] = frozenset(SEGMENTS)) -> dict:
    """By length, a 64-bit number for the segment at each position."""
    import numpy as np

    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    found = {1: points * np.uint64(0x9E3779B97F4A7C15)}
    for length, (first, second) in SEGMENTS.items():
        if length not in needed:
            continue
        n = max(0, len(points) - length + 1)
        factor = np.uint64(pow(0xD6E8FEB86659FD93, second, 1 << 64))
        found[length] = found[first][:n] * factor + found[second][first : first + n]
    return found


def _mixed(numbers):
    import numpy as np

    numbers = (numbers ^ (numbers >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return numbers ^ (numbers >> np.uint64(29))


def _slots(numbers, bits: int = TABLE_BITS):
    import numpy as np

    return (_mixed(numbers) >> np.uint64(64 - bits)).astype(np.int64)


def _slot_counts(documents: list[str], length: int):
    """In how many texts the segments of each slot are."""
    import numpy as np

    counts, needed = np.zeros(1 << COUNT_BITS, np.int32), _needed(length)
    for text in documents:
        counts[_slots(_hashes(text, needed)[length], COUNT_BITS)] += 1  # once a text
    return counts


def _counted(documents: list[str], length: int, wanted, least: int = 1, known=None):
    """Segments of one length in wanted slots, by number: those in ``least`` texts, and among the known numbers if any.

    Their numbers, in how many different contexts and in how many texts of its own each is, a place (text, position).
    """
    import numpy as np

    before = 8
    alone, both = _needed(length), _needed(length, before)

    def counts() -> Iterator[int]:
        """Of each text how many positions are wanted."""
        for text in documents:
            yield np.count_nonzero(wanted[_slots(_hashes(" " * before + text, alone)[length][before:], COUNT_BITS)])

    def kept(part: int, parts: int) -> Iterator:
        """Of each text the wanted segments with their contexts and places; hashed anew for each part, a range of numbers."""
        least_number, last_number = (np.uint64((p << 64) // parts - past) for p, past in ((part, 0), (part + 1, 1)))
        for k, text in enumerate(documents):
            # What stands before the text's first characters is the same for all texts.
            hashes = _hashes(" " * before + text, both)
            own = hashes[length][before:]
            at = np.flatnonzero((own >= least_number) & (own <= last_number))
            at = at[wanted[_slots(own[at], COUNT_BITS)]]
            if known is not None:
                at = at[known[np.minimum(np.searchsorted(known, own[at]), len(known) - 1)] == own[at]]
            own = own[at]
            yield own, _mixed(own) + hashes[before][at], (k << 32) + at

    parts = -(-int(sum(counts())) // COUNTED) or 1
    done = []
    for part in range(parts):
        columns = [list(column) for column in zip(*kept(part, parts))]
        if not columns:
            continue
        # One column at a time, so that little is there twice.
        numbers, pairs, places = (np.concatenate(columns.pop(0)) for _ in range(3))
        # A copy of a text has no context of its own.
        first = np.unique(pairs, return_index=True)[1]
        first.sort()
        numbers, places = numbers[first], places[first]
        del pairs, first
        if not len(numbers):
            continue
        order = np.argsort(numbers, kind="stable")
        numbers, places = numbers[order], places[order]
        fresh = np.r_[True, numbers[1:] != numbers[:-1]]
        starts = np.flatnonzero(fresh)
        texts = fresh | np.r_[True, places[1:] >> 32 != places[:-1] >> 32]
        within = np.add.reduceat(texts.astype(np.int64), starts)
        enough = within >= least
        found = numbers[starts], np.diff(np.r_[starts, len(numbers)]), within, places[starts]
        done.append(tuple(x[enough] for x in found))
    if not done:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    numbers, contexts, within, places = map(np.concatenate, zip(*done))
    order = np.argsort(numbers)
    return numbers[order], contexts[order], within[order], places[order]


def _spelled(texts: list[str], place: int, length: int) -> str:
    at = int(place) & 0xFFFFFFFF
    return texts[int(place) >> 32][at : at + length]


def _common(other: list[str]) -> list[tuple[float, str]]:
    """What is in many texts, by contexts, ranked; the least go first."""
    import numpy as np

    most = DICTIONARY_BYTES // 3 // 8
    counts = _slot_counts(other, 8)
    _, counts, _, places = _counted(other, 8, counts >= max(1, np.partition(counts, -most)[-most] // 2))
    top = np.argsort(-counts, kind="stable")[:most]
    return [(float(rank), _spelled(other, places[k], 8)) for rank, k in enumerate(top)]


def _typical(own: list[str], other: list[str], length: int) -> list[tuple[float, str]]:
    """Segments of one length that are typical of the first texts, ranked; the least go first."""
    import numpy as np

    a, b = sum(map(len, own)), sum(map(len, other))
    found = _slot_counts(own, length)
    candidates = np.count_nonzero(found)
    mine, n, _, places = _counted(own, length, found >= LEAST_TEXTS, LEAST_TEXTS)
    if not len(mine):
        return []
    wanted = np.zeros(1 << COUNT_BITS, bool)
    wanted[_slots(mine, COUNT_BITS)] = True
    theirs, counts, _, _ = _counted(other, length, wanted, known=mine)
    m = np.zeros(len(mine), np.int64)
    m[np.searchsorted(mine, theirs)] = counts
    rate = ((n + 0.5) / a) / ((m + 0.5) / b)
    # Twice the logarithm of the likelihood ratio; by chance alone about one segment in all would pass.
    both = (n + m) / (a + b)
    ratio = 2 * (n * np.log(n / (a * both)) + m * np.log(np.maximum(m, 1) / (b * both)))
    # Contexts repeat in texts of few words; so the share of texts counts as well.
    slots = _slots(mine, COUNT_BITS)
    spread = found[slots] / len(own) > 2 * _slot_counts(other, length)[slots] / max(1, len(other))
    passed = np.flatnonzero(spread & (rate > TYPICAL) & (ratio > 2 * np.log(candidates + 1)))
    # One dictionary holds no more than these.
    passed = passed[np.argsort(-ratio[passed], kind="stable")][: DICTIONARY_BYTES // (3 * (length + 1)) + 1]
    return [(-float(ratio[k]), _spelled(own, places[k], length)) for k in passed]


#: In place of a length: the frequent segments of ordinary text.
COMMON = 0


def _segments(rows: DataFrame) -> dict[bool, tuple[list[str], list[str]]]:
    """Of the first half (False) and of all (True): segments typical of toxic text, the most frequent of the rest; best first.

    Each length is a group of its own, of at most the sample's rows; only what a dictionary may hold comes to the driver.
    """

    def run(table: pa.Table) -> pa.Table:
        full, length = table.column("full")[0].as_py(), table.column("length")[0].as_py()
        texts_of: dict[int, list[str]] = {0: [], 1: []}
        for row in table.select(["doc_id", "text", "label"]).sort_by([("doc_id", "ascending"), ("text", "ascending")]).to_batches(256):
            for label, text in zip(row.column("label").to_pylist(), row.column("text").to_pylist()):
                texts_of[label].append(_folded(text))
        found = _common(texts_of[0]) if length == COMMON else _typical(texts_of[1], texts_of[0], length)
        texts_of.clear()
        give_back()
        return pa.table(
            {
                "full": pa.array([full] * len(found), pa.bool_()),
                "length": pa.array([length] * len(found), pa.int32()),
                "rank": pa.array([r for r, _ in found], pa.float64()),
                "segment": pa.array([x.encode("utf-8", "surrogatepass") for _, x in found], pa.binary()),
            }
        )

    parts = F.when(F.col("half") == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(True)))
    lengths = F.array(*(F.lit(x) for x in (COMMON, *SEGMENTS)))
    dealt = rows.select("doc_id", "text", "label", F.explode(parts).alias("full")).select(
        "*", F.explode(lengths).alias("length")
    )
    found = (
        dealt.where((F.col("length") != COMMON) | (F.col("label") == 0))
        .groupBy("full", "length")
        .applyInArrow(run, "full boolean, length int, rank double, segment binary")
    )
    ranked: dict[tuple[bool, bool], list[tuple[float, str]]] = {}
    for r in found.collect():
        segment = bytes(r["segment"]).decode("utf-8", "surrogatepass")
        ranked.setdefault((r["full"], r["length"] == COMMON), []).append((r["rank"], segment))
    chosen = {}
    for full in (False, True):
        typical: list[str] = []
        size = 0
        for _, segment in sorted(ranked.get((full, False), [])):
            size += 3 * (len(segment) + 1)
            if size > DICTIONARY_BYTES:
                break
            typical.append(segment)
        chosen[full] = typical, [segment for _, segment in sorted(ranked.get((full, True), []))]
    return chosen


class Windows:
    """Gains of the toxic dictionary by window, remembered."""

    def __init__(self, typical: list[str], common: list[str]):
        import hashlib

        import numpy as np

        self.codes = Remembered(
            lambda c: hashlib.blake2b(c.encode("utf-8", "replace"), digest_size=3).digest(), 20_000
        )
        content = b"".join(self._spelled(s) for s in reversed(common))
        # Segments apart, so that no match runs on; the ordinary dictionary has as many bytes, so offsets are alike.
        more = b"".join(self._spelled(s) + hashlib.blake2b(s.encode("utf-8", "replace"), digest_size=3).digest() for s in reversed(typical))
        filler = hashlib.shake_256(b"filler").digest(len(more))
        self.ordinary, self.toxic = self._compressor(content + filler), self._compressor(content + more)
        self.windows = Remembered(self._gain, REMEMBERED)
        self.tables = {}
        for length in SEGMENTS:
            wanted = [s for s in typical if len(s) == length]
            if wanted:
                table = np.zeros(1 << TABLE_BITS, bool)
                table[[int(_slots(_hashes(s)[length])[0]) for s in wanted]] = True
                self.tables[length] = table, frozenset(wanted)

    def _spelled(self, text: str) -> bytes:
        return b"".join(map(self.codes.__getitem__, text))

    def _compressor(self, content: bytes):
        import zstandard as zs

        dictionary = zs.ZstdCompressionDict(content or b"\0" * 8, dict_type=zs.DICT_TYPE_RAWCONTENT)
        settings = zs.ZstdCompressionParameters(
            strategy=zs.STRATEGY_BTULTRA2, min_match=6, window_log=19, hash_log=17, chain_log=17, search_log=10,
            target_length=256, write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        return zs.ZstdCompressor(dict_data=dictionary, compression_params=settings)

    def _gain(self, window: str) -> int:
        data = self._spelled(window)
        return len(self.ordinary.compress(data)) - len(self.toxic.compress(data))

    def _touched(self, text: str) -> list[int]:
        """Starts of the windows that hold a toxic segment, in order."""
        import numpy as np

        found: set[int] = set()
        longest = max(SEGMENTS)
        for a in range(0, len(text), STRETCH):
            stretch = text[a : a + STRETCH + longest - 1]
            hashes = _hashes(stretch)
            for length, (table, wanted) in self.tables.items():
                for at in np.flatnonzero(table[_slots(hashes[length])]).tolist():
                    if stretch[at : at + length] in wanted:
                        first = max(0, -(-(a + at + length - WINDOW) // STEP))
                        found.update(range(first * STEP, a + at + 1, STEP))
        return sorted(found)

    def features(self, text: str) -> list[float]:
        """Of the hits at each threshold: number, share, and whether there are one, two, three."""
        import numpy as np

        text = _folded(text)
        starts = self._touched(text)
        gains = np.array([self.windows[text[a : a + WINDOW]] for a in starts], np.int64)
        starts = np.array(starts, np.int64)
        found: list[float] = []
        for gain in GAINS:
            # Windows that touch are one hit.
            hits = starts[gains >= gain]
            n = int((np.diff(hits) >= WINDOW).sum()) + 1 if len(hits) else 0
            found += [np.log1p(n), np.log1p(600 * n / len(text)), n >= 1, n >= 2, n >= 3]
        return found


def _measured(rows: DataFrame, typical: list[str], common: list[str]) -> tuple[list, list]:
    """Features and labels of the rows, in order; the texts stay with the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Windows(typical, common).features
        for batch in batches:
            found = [[float(x) for x in measure(t)] for t in texts(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(found, pa.list_(pa.float64()))],
                ["doc_id", "label", "features"],
            )

    # Long texts are dealt out, as the sample may be a file or two.
    dealt = rows.select("doc_id", "text", "label").repartition(2 * rows.sparkSession.sparkContext.defaultParallelism, "doc_id", "text")
    found = dealt.mapInArrow(tidy(run), "doc_id long, label int, features array<double>").collect()
    found.sort(key=lambda r: (r["label"], r["doc_id"], r["features"]))
    return [r["features"] for r in found], [r["label"] for r in found]


def train_toxicity(docs: DataFrame, labels: DataFrame) -> dict:
    """Dictionaries and calibration; without labels of both classes all scores are the prior.

    Texts stay with the tasks: segments, and numbers of windows by gain, come to the driver.
    """
    rows = stored(sampled(docs, labels, "toxic"), "sample")
    share = prior(labels, "toxic")
    if rows.select("label", "half").distinct().count() < 4:
        return {"typical": [], "common": [], "share": share, "fit": None}
    segments = _segments(rows)
    # Calibrated on texts that the first dictionaries did not see; those of the model hold the segments of all.
    x, y = _measured(rows.where("half = 1"), *segments[False])
    typical, common = segments[True]
    return {"typical": typical, "common": common, "share": share, "fit": logistic(x, y, share, 1e-5)}


class Sizes:
    """Compressed sizes of a text under two dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard as zs

        self.good, self.bad, self.plain = (
            zs.ZstdCompressor(level=3, dict_data=zs.ZstdCompressionDict(d) if d else None, write_content_size=False)
            for d in (good, bad, b"")
        )

    def features(self, text: str) -> list[float]:
        """Normalised difference and sizes; long texts go through in blocks."""
        import math

        data = text.encode("utf-8", "replace")
        sizes = [0, 0, 0]
        for a in range(0, max(1, len(data)), BLOCK):
            block = data[a : a + BLOCK]
            for k, compressor in enumerate((self.good, self.bad, self.plain)):
                sizes[k] += len(compressor.compress(block))
        n = len(data) + 24
        good, bad, plain = (s / n for s in sizes)
        gap, size = good - bad, math.log(n)
        # The worst part counts as well: a text may be bad in places.
        worst = max((self._gap(data[a : a + 1500]) for a in range(0, max(1, len(data)), 1500)), default=0.0)
        low = min((self._share(data[a : a + 1500]) for a in range(0, max(1, len(data)), 1500)), default=0.0)
        return [gap, gap * gap, good, good * good, bad, plain, plain * plain, size, gap * size, good * size, worst, worst * worst, low, low * low, worst * size, low * size]

    def _gap(self, block: bytes) -> float:
        return (len(self.good.compress(block)) - len(self.bad.compress(block))) / (len(block) + 24)

    def _share(self, block: bytes) -> float:
        return len(self.good.compress(block)) / (len(block) + 24)


def train_quality(docs: DataFrame, labels: DataFrame) -> dict:
    """Dictionaries and calibration; without labels of both classes all scores are the prior."""
    import zstandard as zs

    rows = sample(docs, labels, "quality")
    parts = {(y, h): [t for t, label, half in rows if (label, half) == (y, h)] for y in (0, 1) for h in (0, 1)}
    share = prior(labels, "quality")
    if not all(parts.values()):
        return {"good": b"", "bad": b"", "share": share, "fit": None}
    dictionaries = []
    for y in (1, 0):
        pieces = [p for t in parts[y, 0] for b in [t.encode("utf-8", "replace")] for p in (b[a : a + 2000] for a in range(0, len(b), 2000))]
        try:
            dictionaries.append(zs.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes())
        except zs.ZstdError:  # too little text to train on: the text itself serves
            dictionaries.append(b"".join(pieces)[-DICTIONARY_BYTES:])
    good, bad = dictionaries
    measure = Sizes(good, bad).features
    x = [measure(t) for y in (0, 1) for t in parts[y, 1]]
    y = [y for y in (0, 1) for _ in parts[y, 1]]
    return {"good": good, "bad": bad, "share": share, "fit": logistic(x, y, share, 1e-5)}


def _scored(docs: DataFrame, model: dict, measure: Callable, threshold: float, keep: list[str]) -> DataFrame:
    """The named columns, score and predicted of every row; a null text is empty."""
    schema = T.StructType(
        [*docs.select(*keep).schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        features = measure(model) if model["fit"] is not None else None
        for batch in batches:
            values = texts(batch, "text")
            if features is None:
                found = np.full(len(values), model["share"])
            else:
                found = scores(model["fit"], [features(t) for t in values])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in keep),
                    pa.array(found, pa.float64()),
                    pa.array((found >= threshold).astype(np.int32)),
                ],
                [*keep, "score", "predicted"],
            )

    columns = docs.select(*dict.fromkeys([*keep, "text"]))
    return columns.mapInArrow(tidy(run), schema)


def _windows_of(model: dict) -> Callable:
    return Windows(model["typical"], model["common"]).features


def _sizes_of(model: dict) -> Callable:
    return Sizes(model["good"], model["bad"]).features


def toxicity(docs: DataFrame, model: dict, keep: list[str]) -> DataFrame:
    """Likelihood of the toxic label, 1 from 0.5 up, for every row; null and empty texts have no hits."""
    return _scored(docs, model, _windows_of, 0.5, keep)


def quality(docs: DataFrame, model: dict, keep: list[str]) -> DataFrame:
    """Likelihood of the good label, 1 from 0.3 up, for every row; null and empty texts have size 0."""
    return _scored(docs, model, _sizes_of, 0.3, keep)
