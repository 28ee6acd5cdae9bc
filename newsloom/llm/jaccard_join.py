"""Exact join of texts whose sets of five-word shingles have a Jaccard similarity of 0.8.

One minus the similarity is a metric, so the join works on pivots and regions.

Almost all pairs of texts share nothing and lie at distance 1. Whole texts as
pivots cannot part such a space: each text would be as near to one pivot as to
another, and windows would copy it into every region. The first pivots are
therefore the sets of a single shingle. A text lies nearest to those it holds;
ties go by one order of all shingles, rare ones first. Of two linked texts
neither holds more than a fifth that the other lacks, so the first shingle that
they share is among the first floor(n / 5) + 1 of either: a text is copied into
as many regions as this window has, and each linked pair meets in one.

Inside a region the pivots are texts. Let r be 0.2, the distance of a link:

* A text within r of a pivot is of the pivot's class and at home with the nearest
  such pivot: its Voronoi region. All its partners are within 2 r of that pivot
  and are copied into the region as guests. Pairs to look at have a text at home,
  two classes, and distances to the pivot that differ by no more than r. Regions
  with a pivot in common share this one.
* Texts within r of no pivot form the outer region.

Regions that hold one class are done, others join again in the same way with
more pivots; small ones, and all of the last round, compare their pairs directly.
Classes are brought up to date after each round. Only classes matter, so pairs
inside one are never made: a group of near copies goes as soon as its pivot has
been compared with each.

Before two sets are compared, so are their profiles: bits, two to four for each
shingle, of whether an odd number of shingles falls into a class. Profiles differ in
no more bits than the sets in shingles, so they bound the distance from below, and
pairs too far apart by them are dropped without reading either text. Sets are
compared only where profiles allow a link. Guests need no more than the bound: a
partner of a text at home at distance d is within d + r of the pivot, so its bound is.

Large regions are dealt into blocks, and a row of their join is a pair of blocks
whose profiles are compared inside the task: only pairs that a bound allows come out.

Shingles, and words before them, are 64-bit hashes; sets are told apart by
128-bit digests, of which windows carry the first half.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsloom.llm.common import binaries, hashed, tidy
from newsloom.llm.components import components
from newsloom.session import stored

SHINGLE_WORDS = 5
#: Percent of the union that linked sets have in common, at least.
LINK_PERCENT = 80
#: Similarity at twice the distance of a link, in percent.
REACH_PERCENT = 60
#: Distance of a link, with room for rounding.
RADIUS = 1 - LINK_PERCENT / 100 + 1e-9
#: Bins of the fixed-size count that tells rare shingles from common ones.
BINS = 1 << 16
#: For each round: the largest region whose pairs are compared directly, and its pivots.
ROUNDS = ((2, "one"), (24, "root"), (None, None))
#: Texts of a region in a block.
BLOCK = 256
#: Bits of the shortest profile and of the longest one.
PROFILE_BITS = (256, 1 << 16)


def shingles(text: bytes):
    """Sorted hashes of the distinct shingles of a text; with fewer words, of all words as one."""
    import numpy as np

    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII blanks
    hashes = hashed(words)
    width = min(SHINGLE_WORDS, len(words))
    if not width:
        return hashes
    n = len(words) - width + 1
    mixed = np.full(n, 0x9E3779B97F4A7C15 + width, dtype=np.uint64)
    for k in range(width):
        mixed ^= hashes[k : k + n]
        mixed *= np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def _digest(found) -> tuple[int, int]:
    import xxhash

    raw = xxhash.xxh128(found.tobytes()).digest()
    return int.from_bytes(raw[:8], "big", signed=True), int.from_bytes(raw[8:], "big", signed=True)


def _bin(found):
    import numpy as np

    return (found >> np.uint64(48)).astype(np.int64)


def _profile(found) -> bytes:
    """One bit per class: whether it holds an odd number of shingles. A power of two of classes."""
    import numpy as np

    least, most = PROFILE_BITS
    bits = min(max(1 << (2 * len(found)).bit_length(), least), most)
    counts = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _folded(rows, words: int):
    """Profiles, rows of 64-bit words, as they would be with this many words."""
    import numpy as np

    return np.bitwise_xor.reduce(rows.reshape(len(rows), -1, words), axis=1)


class Profiles:
    """A list of profiles, by length."""

    def __init__(self, profiles: list[bytes]):
        import numpy as np

        words = np.array([len(v) // 8 for v in profiles])
        self.groups = {}
        for length in np.unique(words).tolist():
            at = np.flatnonzero(words == length)
            rows = np.frombuffer(b"".join([profiles[k] for k in at]), np.uint64).reshape(-1, length)
            self.groups[length] = (at, {length: rows})
        self.n = len(profiles)

    def apart(self, profile: bytes):
        """For each the least number of shingles that are in one of the two sets alone."""
        import numpy as np

        one, found = np.frombuffer(profile, np.uint64).reshape(1, -1), np.empty(self.n, np.int64)
        for length, (at, rows) in self.groups.items():
            words = min(length, one.shape[1])
            if words not in rows:
                rows[words] = _folded(rows[length], words)
            found[at] = np.bitwise_count(rows[words] ^ _folded(one, words)).sum(axis=1, dtype=np.int64)
        return found


def _apart(x: list[bytes], y: list[bytes]):
    """For each row of two lists the least number of shingles that are in one of the two sets alone."""
    import numpy as np

    found = np.empty(len(x), np.int64)
    lengths = np.array([[len(v) // 8 for v in side] for side in (x, y)], dtype=np.int64).reshape(2, -1)
    for p, q in {*zip(*lengths.tolist())}:
        at = np.flatnonzero((lengths[0] == p) & (lengths[1] == q))
        rows = (np.frombuffer(b"".join([side[k] for k in at]), np.uint64).reshape(len(at), -1) for side in (x, y))
        left, right = (_folded(v, min(p, q)) for v in rows)
        found[at] = np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64)
    return found


def _bound(apart, sizes):
    """The least distance of sets with these sizes together that are this far apart."""
    return 2 * apart / (sizes + apart)


MEASURED = "doc_id long, n long, high long, low long, profile binary, bin long, count long"


def _measured(docs: DataFrame) -> DataFrame:
    """Of each text its number of shingles, digest and profile; after them, counts of shingles by bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        names = ["doc_id", "n", "high", "low", "profile", "bin", "count"]
        counts = np.zeros(BINS, dtype=np.int64)
        for batch in batches:
            sizes, highs, lows, profiles = [], [], [], []
            for text in binaries(batch, "text"):
                found = shingles(text)
                counts += np.bincount(_bin(found), minlength=BINS)
                high, low = _digest(found)
                sizes.append(len(found))
                highs.append(high)
                lows.append(low)
                profiles.append(_profile(found))
            none = pa.nulls(len(sizes), pa.int64())
            numbers = [pa.array(x, pa.int64()) for x in (sizes, highs, lows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *numbers, pa.array(profiles, pa.binary()), none, none], names
            )
        bins = np.flatnonzero(counts)
        none = pa.nulls(len(bins), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.nulls(len(bins), pa.binary()), pa.array(bins, pa.int64()), pa.array(counts[bins], pa.int64())],
            names,
        )

    return docs.mapInArrow(tidy(run), MEASURED)


def _windows(docs: DataFrame, order) -> DataFrame:
    """(region, high): the first shingles of each text, rare ones first; copies in a task once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        seen = set()
        for batch in batches:
            regions, highs = [], []
            for text in binaries(batch, "text"):
                found = shingles(text)
                n = len(found)
                high, _ = _digest(found)
                if not n or high in seen:
                    continue
                seen.add(high)
                width = n - (LINK_PERCENT * n + 99) // 100 + 1
                regions.append(found[np.argsort(order[_bin(found)], kind="stable")[:width]].view(np.int64))
                highs.append(np.full(width, high))
            if regions:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x), pa.int64()) for x in (regions, highs)], ["region", "high"]
                )

    return docs.select("text").mapInArrow(tidy(run), "region long, high long")


def _shared(windows: DataFrame) -> DataFrame:
    """(region, high) -> each row once, of regions with several digests; dealt out once, by ranges of both.

    A region may go on in the next range, so the first row of a range and its last are kept: a region of one
    text more, here and there, which has no pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def batch_of(regions, highs) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(regions, pa.int64()), pa.array(highs, pa.int64())], ["region", "high"])

        # The latest row waits for the next one; whether the one before it is of its region.
        regions = highs = np.zeros(0, np.int64)
        tied = True
        for batch in batches:
            if not batch.num_rows:
                continue
            regions, highs = (np.concatenate([x, batch.column(c).to_numpy()]) for x, c in ((regions, "region"), (highs, "high")))
            same = regions[1:] == regions[:-1]
            fresh = np.r_[True, ~same | (highs[1:] != highs[:-1])]
            regions, highs = regions[fresh], highs[fresh]
            same = regions[1:] == regions[:-1]
            before = np.r_[tied, same]
            kept = before[:-1] | same
            yield batch_of(regions[:-1][kept], highs[:-1][kept])
            regions, highs, tied = regions[-1:], highs[-1:], bool(before[-1])
        yield batch_of(regions, highs)

    n = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = windows.repartitionByRange(n, "region", "high").sortWithinPartitions("region", "high")
    return dealt.mapInArrow(tidy(run), "region long, high long")


def _sets(docs: DataFrame) -> DataFrame:
    """(doc_id, high, text) -> (doc_id, shingles) of the texts with this digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sets = [], []
            for doc_id, high, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("high").to_pylist(), binaries(batch, "text")
            ):
                found = shingles(text)
                if _digest(found)[0] == high:  # an id may stand on several texts
                    ids.append(doc_id)
                    sets.append(found.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], ["doc_id", "shingles"]
            )

    return docs.select("doc_id", "high", "text").mapInArrow(tidy(run), "doc_id long, shingles binary")


POSSIBLE = "a long, b long, sizes long, apart long"


def _possible(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b, percent) -> pairs whose profiles allow this similarity, with both sizes and the bits that differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = _apart(batch.column("px").to_pylist(), batch.column("py").to_pylist())
            percent, sizes = batch.column("percent").to_numpy(), batch.column("sizes").to_numpy()
            kept = pa.array(apart * (100 + percent) <= (100 - percent) * sizes)
            columns = [*(batch.column(c) for c in ("a", "b", "sizes")), pa.array(apart, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "sizes", "apart"]).filter(kept)

    x = known.select(F.col("text").alias("a"), F.col("n").alias("nx"), F.col("profile").alias("px"))
    y = known.select(F.col("text").alias("b"), F.col("n").alias("ny"), F.col("profile").alias("py"))
    both = pairs.join(x, "a").join(y, "b").select("a", "b", "percent", (F.col("nx") + F.col("ny")).alias("sizes"), "px", "py")
    return both.mapInArrow(tidy(run), POSSIBLE)


def _blocked(x: DataFrame, y: DataFrame, known: DataFrame, percent: int, links: bool) -> DataFrame:
    """Pairs of a text of ``x`` and one of ``y`` in a region whose profiles allow this similarity.

    With ``links`` only pairs that can tie two classes: of a text at home and another,
    with distances to the pivot that allow a link. A row of the join is a pair of blocks.
    ``y`` are whole regions, with their ``size``.
    """
    columns = ["text", "n", "class", "home", "distance", "profile"]

    def blocks(rows: DataFrame, side: str, size) -> DataFrame:
        number = F.pmod(F.xxhash64("text", F.lit(side)), F.ceil(size / BLOCK).cast("long"))
        # Dealt out by region once: blocks are put together where they are joined.
        return (
            rows.select("region", *columns[:-1], number.alias("block"))
            .join(known.select("text", "profile"), "text")
            .repartition(n, "region")
            .groupBy("region", "block")
            .agg(F.collect_list(F.struct(*columns)).alias(side))
            .select("region", side)
        )

    n = int(x.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = blocks(x, "x", F.count("*").over(W.partitionBy("region")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def parts(values: pa.ListScalar):
            found = values.values.flatten()
            return [v.to_numpy(zero_copy_only=False) for v in found[:-1]], found[-1].to_pylist()

        for batch in batches:
            for left, right in zip(batch.column("x"), batch.column("y")):
                (ids, n, classes, home, distance), profiles = parts(left)
                (ids_y, n_y, classes_y, home_y, distance_y), profiles_y = parts(right)
                profiles_y = Profiles(profiles_y)
                for k in range(len(ids)):
                    fits = (np.minimum(n[k], n_y) * 100 >= np.maximum(n[k], n_y) * percent) & (ids[k] != ids_y)
                    if links:
                        fits &= classes[k] != classes_y
                        # A guest's distance is a bound from below.
                        fits &= (home_y & (distance[k] <= distance_y + RADIUS)) | (home[k] & (distance_y <= distance[k] + RADIUS))
                    if not fits.any():
                        continue
                    apart, sizes = profiles_y.apart(profiles[k]), n[k] + n_y
                    kept = fits & (apart * (100 + percent) <= (100 - percent) * sizes)
                    other = ids_y[kept]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(v, pa.int64())
                            for v in (np.minimum(ids[k], other), np.maximum(ids[k], other), sizes[kept], apart[kept])
                        ],
                        ["a", "b", "sizes", "apart"],
                    )

    return counted.join(blocks(y, "y", F.col("size")), "region").select("x", "y").mapInArrow(tidy(run), POSSIBLE)


def _compared(pairs: DataFrame, docs: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b) -> (a, b, common, total): sizes of intersection and union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            common, total = [], []
            for x, y in zip(batch.column("sx").to_pylist(), batch.column("sy").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")  # two sorted runs are merged
                same = int((both[1:] == both[:-1]).sum())
                common.append(same)
                total.append(len(both) - same)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(common, pa.int64()), pa.array(total, pa.int64())],
                ["a", "b", "common", "total"],
            )

    ids = pairs.select(F.col("a").alias("text")).union(pairs.select(F.col("b").alias("text"))).distinct()
    # Stored, so that its size is known when the texts are joined.
    ids = stored(ids.join(known.select("text", "high"), "text"), "ids").withColumnRenamed("text", "doc_id")
    sets = stored(_sets(docs.join(ids, "doc_id")), "sets")
    x = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sx"))
    y = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sy"))
    both = pairs.join(x, "a").join(y, "b").select("a", "b", "sx", "sy")
    return both.mapInArrow(tidy(run), "a long, b long, common long, total long")


def _pair(x, y, percent: int):
    """Ids in order, if the sizes allow this similarity."""
    return (F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * percent) & (x["text"] != y["text"])


def _ordered(x, y, percent: int) -> list:
    return [
        F.least(x["text"], y["text"]).alias("a"),
        F.greatest(x["text"], y["text"]).alias("b"),
        F.lit(percent).cast("long").alias("percent"),
    ]


def _classed(members: DataFrame, classes: DataFrame | None) -> DataFrame:
    """Members of the regions with a text at home and more than one class, with class and size of region."""
    if classes is None:
        now = members.withColumn("class", F.col("text"))
    else:
        now = members.join(classes, members["text"] == classes["node"], "left").select(
            "region", "text", "n", "home", "distance", F.coalesce("component", "text").alias("class")
        )
        now = stored(now, "members")
    open_ = (
        now.groupBy("region")
        .agg(
            F.count("*").alias("size"),
            F.min("class").alias("least"),
            F.max("class").alias("most"),
            F.max("home").alias("home"),
        )
        .where("least <> most AND home")
        .select("region", "size")
    )
    return stored(now.join(open_, "region"), "members")


def _links(members: DataFrame, known: DataFrame, docs: DataFrame) -> DataFrame:
    """(region, text, n, home, distance) -> links (a, b) that tie together all linked texts.

    ``distance`` is that to the region's pivot, 0 where it has none.
    """
    links = classes = None
    for number, (direct, pivots) in enumerate(ROUNDS):
        if links is not None:
            classes = components(links)
            links = classes.select(F.col("node").alias("a"), F.col("component").alias("b"))
        members = _classed(members, classes)
        if members.isEmpty():
            return links if links is not None else members.select(F.col("text").alias("a"), F.col("text").alias("b"))
        x, y = members.alias("x"), members.alias("y")
        x, y = ({c: F.col(f"{k}.{c}") for c in members.columns} for k in "xy")
        if direct is None:
            found = _blocked(members.where("home"), members, known, LINK_PERCENT, links=True)
        else:
            small = members.where(F.col("size") <= direct)
            pairs = (
                small.alias("x")
                .join(small.alias("y"), x["region"] == y["region"])
                .where(
                    (x["text"] < y["text"])
                    & (x["class"] != y["class"])
                    # A guest's distance is a bound from below.
                    & (
                        (x["home"] & (y["distance"] <= x["distance"] + RADIUS))
                        | (y["home"] & (x["distance"] <= y["distance"] + RADIUS))
                    )
                    & _pair(x, y, LINK_PERCENT)
                )
                .select(*_ordered(x, y, LINK_PERCENT))
            )
            large = members.where(F.col("size") > direct)
            draw = F.pmod(F.xxhash64("text", F.lit(number)), F.lit(1 << 30)) / F.lit(float(1 << 30))
            # Always the least text, which all regions of a group of copies agree on.
            first = large.groupBy("region").agg(F.min(F.struct("text", "n")).alias("first"))
            chosen = first.select("region", "first.text", "first.n")
            if pivots == "root":
                drawn = large.where(draw * F.sqrt("size") < 1).select("region", "text", "n")
                chosen = chosen.union(drawn).distinct()
            chosen = stored(chosen, "pivots")
            if pivots == "root":
                drawn = large.join(chosen, ["region", "text"], "left_semi")
                by_pivot = _blocked(drawn, large, known, REACH_PERCENT, links=False)
                found = _possible(pairs.distinct(), known).union(by_pivot)
            else:
                by_pivot = (
                    large.alias("x")
                    .join(chosen.alias("y"), x["region"] == y["region"])
                    .where(_pair(x, y, REACH_PERCENT))
                    .select(*_ordered(x, y, REACH_PERCENT))
                )
                pairs = pairs.union(by_pivot)
                found = _possible(pairs.groupBy("a", "b").agg(F.min("percent").alias("percent")), known)
        found = stored(found.distinct(), "pairs")
        allowed = F.col("apart") * (100 + LINK_PERCENT) <= (100 - LINK_PERCENT) * F.col("sizes")
        near = _compared(found.where(allowed).select("a", "b"), docs, known).select(
            "a",
            "b",
            (F.col("common") * 100 >= F.col("total") * LINK_PERCENT).alias("core"),
            (1 - F.col("common") / F.col("total")).alias("distance"),
        )
        near = stored(near, "near")
        close = near.where("core").select("a", "b")
        links = close if links is None else links.union(close)  # of earlier rounds, as stars
        if direct is not None:
            # The distances of possible links are exact, others within reach are bounded from below.
            bound = _bound(F.col("apart"), F.col("sizes")).alias("distance")
            near = near.union(found.where(~allowed).select("a", "b", F.lit(False).alias("core"), bound))
            both = near.union(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "core", "distance"))
            both = both.select(F.col("a").alias("text"), F.col("b").alias("pivot"), "core", "distance")
            nearest = F.min(F.struct("distance", "pivot")).alias("nearest")
            homes = stored(
                large.select("region", "text")
                .join(both.where("core"), "text")
                .join(chosen.select("region", F.col("text").alias("pivot")), ["region", "pivot"], "left_semi")
                .groupBy("region", "text")
                .agg(nearest)
                .select("region", "text", "nearest.pivot", "nearest.distance"),
                "homes",
            )
            # Named by the pivot alone: regions that share a pivot give one region of its neighbours.
            at_home = homes.select("pivot", "text", "distance", F.lit(True).alias("home"))
            inner = (
                both.join(homes.select("pivot").distinct(), "pivot", "left_semi")
                .select("pivot", "text", "distance", F.lit(False).alias("home"))
                .union(at_home)
                .groupBy("pivot", "text")
                .agg(F.max("home").alias("home"), F.max("distance").alias("distance"))
                .join(known.select("text", "n"), "text")
                .select(F.xxhash64("pivot", F.lit("inner")).alias("region"), "text", "n", "home", "distance")
            )
            settled = homes.select("region", "text").union(chosen.select("region", "text")).distinct()
            outer = large.join(settled, ["region", "text"], "left_anti").select(
                F.xxhash64("region", F.lit("outer")).alias("region"), "text", "n", "home", "distance"
            )
            members = inner.union(outer)
    return links


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> one row per document row: doc_id, n_shingles, class_id, component_id.

    ``class_id`` is the least id with the same set of shingles, ``component_id``
    the least id reachable by links. A null or empty text, or one of blanks, has
    an empty set, which links with nothing. Rows that share an id are one node;
    a row with a null id links with nothing and has null ids. Exact for any sizes
    of groups. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    measured = stored(_measured(docs), "measured")
    order = _order_of_bins(measured)
    rows = measured.where("bin IS NULL").select("doc_id", "n", "high", "low")
    classes = stored(
        rows.where("n > 0 AND doc_id IS NOT NULL")
        .groupBy("high", "low", "n")
        .agg(F.min("doc_id").alias("text")),
        "classes",
    )
    docs = docs.where("doc_id IS NOT NULL")
    windows = stored(_windows(docs, order), "windows")
    members = _shared(windows).join(classes, "high").select(
        "region", "text", "n", F.lit(True).alias("home"), F.lit(0.0).alias("distance")
    )
    members = stored(members, "members")
    used = members.select("text").distinct()
    profiles = measured.where("bin IS NULL").select(F.col("doc_id").alias("text"), "high", "low", "profile")
    known = stored(
        classes.join(used, "text", "left_semi")
        .join(profiles, ["text", "high", "low"])
        .groupBy("text", "high", "n")
        .agg(F.first("profile").alias("profile")),
        "known",
    )

    tied = components(_links(members, known, docs))
    ids = classes.drop("n").join(tied, classes["text"] == tied["node"], "left").select(
        "high", "low", F.col("text").alias("class_id"), F.coalesce("component", "text").alias("component_id")
    )
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    return rows.join(ids, ["high", "low"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _order_of_bins(measured: DataFrame):
    """Place of each bin by its count, rare ones first; one row per bin comes to the driver."""
    import numpy as np

    counts = np.zeros(BINS, dtype=np.int64)
    for row in measured.where("bin IS NOT NULL").groupBy("bin").agg(F.sum("count").alias("count")).collect():
        counts[row["bin"]] = row["count"]
    order = np.empty(BINS, dtype=np.int32)
    order[np.argsort(counts, kind="stable")] = np.arange(BINS, dtype=np.int32)
    return order
