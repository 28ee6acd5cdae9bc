"""Hard negatives by inner product: cover trees searched best first.

Vectors x are put on a sphere: one more component, sqrt(M^2 - |x|^2) with M the
greatest norm, makes the nearest of them to (q, 0) the one with the greatest inner
product with q. For a ball with centre c and covering radius r, every inner product
with q lies within |q| r of that with c; these bounds are all the search needs.

1. Cells: centres are chosen farthest first from a sample of ``SAMPLE`` vectors, and
   every row goes to its nearest one. A cell's radius is measured over all its rows.
2. Trees: a cell of more than ``SHARD`` rows is dealt to several trees. A node takes up to
   ``FAN`` children, farthest first, until half its radius is covered; each
   level's covering radii are measured, so a child is as tight as its rows allow.
3. Search: an anchor goes to the cells whose bounds reach what it still looks for. In a
   tree it opens the node with the greatest upper bound first; nodes outside of
   all windows, or below the last place kept in them, are left out; leaves are
   worked out exactly, in whole numbers. Of the nodes anchors want next, the one that most
   of them name is opened, for all it is good for: one matrix product, not one each.

Positives are looked for in the anchor's own cell first, then in the cells that could
better them, then negatives in the windows that the positives set. Only the sample and
the cells' bounds pass through the driver. A task holds one tree and at most
``ANCHORS`` anchors; a hot cell or a set of equal vectors is many trees.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import stored

POSITIVES = 5
NEGATIVES = 10
#: A negative's score is at least and at most so many hundredths of the positive's.
LOW, HIGH = 30, 90
#: Vectors the cells' centres are chosen from; all rows are then put into cells.
SAMPLE = 8192
CELLS = 1024
#: Rows of a tree, on average at most; rows of a leaf; children of a node.
SHARD = 4096
LEAF = 512
FAN = 16
#: A child of fewer rows is dealt to the others.
CHILD = 32
#: Anchors of a task, on average at most.
ANCHORS = 20_000
#: Room for rounding in bounds, in parts of the greatest norm.
SLACK = 1e-6
EXACT = 2.0**53
FAR = 2**63 - 1
NONE = -FAR
#: Anchors that are searched for at a time.
CHUNK = 2000

PLACE = ["size", "cell", "salt"]
ANCHOR = ["anchor_id", "digest"]
TREE = (
    "size int, cell int, salt int, ids binary, labels binary, vectors binary, largest double, "
    "centres binary, radii binary, first binary, n_children binary, begin binary, low_label binary, high_label binary"
)
TREE_FIELDS = [field.split()[0] for field in TREE.split(", ")]
FOUND = "anchor_id long, digest long, place int, found_id long, score long"


def floored(vector: Column, factor: int = 256) -> Column:
    """Components times ``factor`` as whole numbers, kept as doubles."""

    def whole(x: Column) -> Column:
        y = x.cast("double") * factor
        # From 2^53 on a double is whole already, and may be too large for a long.
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)

    return F.transform(vector, whole)


# ---- vectors and trees, inside tasks -------------------------------------------


def numbers(blob: bytes, kind: str):
    import numpy as np

    return np.frombuffer(blob, kind) if blob else np.empty(0, kind)


def matrix(blobs: list[bytes], size: int):
    import numpy as np

    return numbers(b"".join(blobs), "<f8").reshape(len(blobs), size)


def products(vectors, anchors, largest: float):
    """Exact inner products of whole numbers, anchors by vectors, held within 64 bits."""
    import numpy as np

    if largest * np.abs(anchors).max(initial=0.0) * vectors.shape[1] < EXACT:
        return (anchors @ vectors.T).astype(np.int64)
    rows = [[int(x) for x in v] for v in vectors]
    found = [[sum(int(x) * y for x, y in zip(q, v)) for v in rows] for q in anchors]
    return np.array([[max(1 - FAR, min(FAR - 1, s)) for s in line] for line in found], dtype=np.int64)


def lifted(vectors, norm: float):
    """Vectors with the component that puts them on a sphere of radius ``norm``."""
    import numpy as np

    rest = np.sqrt(np.maximum(norm * norm - (vectors * vectors).sum(axis=1), 0))
    return np.column_stack([vectors, rest])


def _distances(points, centre):
    import numpy as np

    gap = points - centre
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def farthest_first(points, first, most: int, until: float):
    """Indices of centres, and each point's nearest centre and distance to it."""
    import numpy as np

    chosen, near = [first], np.zeros(len(points), dtype=np.int64)
    distance = _distances(points, points[first])
    while len(chosen) < most:
        far = int(distance.argmax())
        if distance[far] <= until:
            break
        other = _distances(points, points[far])
        closer = other < distance
        near[closer] = len(chosen)
        distance[closer] = other[closer]
        chosen.append(far)
    return chosen, near, distance


def _children(points, own: int, until: float):
    """Centres of a node's children, without those that hardly any row is near to."""
    import numpy as np

    chosen, near, distance = farthest_first(points, own, FAN, until)
    large = np.bincount(near, minlength=len(chosen)) >= CHILD
    if large.all() or large.sum() < 2:
        return chosen, near, distance
    chosen = [c for c, kept in zip(chosen, large) if kept]
    far = np.column_stack([_distances(points, points[c]) for c in chosen])
    near = far.argmin(axis=1)
    return chosen, near, far[np.arange(len(points)), near]


def cover_tree(vectors, labels, ids, norm: float) -> dict:
    """Nodes by level; the rows of a node, and its children, stand side by side; a leaf's by id."""
    import numpy as np

    points = lifted(vectors, norm)
    order = np.arange(len(points))
    centres, spans, radii = [0], [(0, len(points))], [float(_distances(points, points[0]).max(initial=0.0))]
    first, n_children = [], []
    at = 0
    while at < len(spans):
        a, b = spans[at]
        first.append(len(spans))
        n_children.append(0)
        if b - a > LEAF and radii[at] > SLACK * norm:
            rows = order[a:b].copy()
            own = int(np.flatnonzero(rows == centres[at])[0])
            chosen, near, distance = _children(points[rows], own, radii[at] / 2)
            if len(chosen) > 1:
                n_children[at] = len(chosen)
                sort = np.argsort(near, kind="stable")
                order[a:b] = rows[sort]
                ends = a + np.concatenate([[0], np.cumsum(np.bincount(near, minlength=len(chosen)))])
                for k, centre in enumerate(chosen):
                    centres.append(int(rows[centre]))
                    spans.append((int(ends[k]), int(ends[k + 1])))
                    radii.append(float(distance[near == k].max()))
        if not n_children[at]:
            order[a:b] = order[a:b][np.argsort(ids[order[a:b]], kind="stable")]
        at += 1
    begin = np.array(spans, dtype=np.int64)
    return {
        "order": order,
        "centres": vectors[centres],
        "radii": np.array(radii),
        "first": np.array(first, dtype=np.int64),
        "n_children": np.array(n_children, dtype=np.int64),
        "begin": begin,
        "low_label": np.array([labels[order[a:b]].min() for a, b in spans]),
        "high_label": np.array([labels[order[a:b]].max() for a, b in spans]),
    }


def _top(scores, fits, k: int):
    """Columns of the ``k`` greatest scores of each row among those that fit; ties to the left."""
    import numpy as np

    n = scores.shape[1]
    if n <= k:
        return np.broadcast_to(np.arange(n), scores.shape)
    bits = n.bit_length()
    if np.abs(scores).max() >= 2 ** (62 - bits):
        return np.argsort(np.where(fits, -scores, FAR), axis=1, kind="stable")[:, :k]
    # One number for score and place, so that ties are told apart.
    whole = np.where(fits, scores * (1 << bits) + (n - 1 - np.arange(n)), NONE)
    return np.argpartition(whole, n - k, axis=1)[:, n - k :]


def search(tree: dict, anchors, labels, own_ids, same: bool, least, most, k: int):
    """The ``k`` best rows of each anchor's windows: scores and ids, anchors by windows by ``k``.

    Greater scores, then smaller ids first; ``NONE`` where there are fewer. ``least`` and ``most``
    are the windows, anchors by windows. ``same`` asks for rows of the anchor's label that are
    not itself, else for other labels. Of the nodes that anchors would open next, each its
    own best, the one most of them name is opened for all anchors it is still good for, as
    one matrix product.
    """
    import numpy as np

    m, n_windows = least.shape
    least, every = least.copy(), np.arange(m)
    norms = np.sqrt((anchors * anchors).sum(axis=1))
    slack = SLACK * norms * tree["norm"] + SLACK
    n_nodes = len(tree["radii"])
    high, low = np.full((m, n_nodes), -np.inf), np.full((m, n_nodes), np.inf)
    scores = np.full((m, n_windows, k), NONE, dtype=np.int64)
    ids = np.zeros((m, n_windows, k), dtype=np.int64)

    def look(rows, a: int, b: int) -> None:
        """Bounds of nodes a to b for some anchors; nodes without a label that fits stay shut."""
        middle = anchors[rows] @ tree["centres"][a:b].T
        spread = norms[rows][:, None] * tree["radii"][a:b] + slack[rows][:, None]
        label, low_label, high_label = labels[rows][:, None], tree["low_label"][a:b], tree["high_label"][a:b]
        fits = (low_label <= label) & (label <= high_label) if same else (low_label != label) | (high_label != label)
        high[rows, a:b] = np.where(fits, middle + spread, -np.inf)
        low[rows, a:b] = middle - spread

    def verify(rows, a: int, b: int) -> None:
        found = products(tree["vectors"][a:b], anchors[rows], tree["largest"])
        fits = tree["labels"][a:b] == labels[rows][:, None]
        fits = fits & (tree["ids"][a:b] != own_ids[rows][:, None]) if same else ~fits
        for w in range(n_windows):
            good = fits & (found >= least[rows, w][:, None]) & (found <= most[rows, w][:, None])
            some = good.any(axis=1)
            if not some.any():
                continue
            r, new = rows[some], np.where(good[some], found[some], NONE)
            column = _top(found[some], good[some], k)
            all_scores = np.concatenate([scores[r, w], np.take_along_axis(new, column, axis=1)], axis=1)
            all_ids = np.concatenate([ids[r, w], tree["ids"][a:b][column]], axis=1)
            best = np.lexsort((all_ids, -all_scores), axis=-1)[:, :k]
            scores[r, w] = np.take_along_axis(all_scores, best, axis=1)
            ids[r, w] = np.take_along_axis(all_ids, best, axis=1)
            least[r, w] = np.maximum(least[r, w], scores[r, w, k - 1])

    look(every, 0, 1)
    while True:
        # Nodes that hold nothing for an anchor any more are shut for good.
        fits = ((high[:, :, None] >= least[:, None, :]) & (low[:, :, None] <= most[:, None, :])).any(axis=2)
        high[~fits] = -np.inf
        asking = np.flatnonzero(fits.any(axis=1))
        if not len(asking):
            break
        x = int(np.bincount(high[asking].argmax(axis=1)).argmax())
        rows = np.flatnonzero(fits[:, x])
        high[rows, x] = -np.inf
        if tree["n_children"][x]:
            a = int(tree["first"][x])
            look(rows, a, a + int(tree["n_children"][x]))
        else:
            verify(rows, *tree["begin"][x].tolist())
    return scores, ids


# ---- the Spark job ---------------------------------------------------------------


def _in_cells(rows: DataFrame, centres: dict, norm: float) -> DataFrame:
    """(vec_id, label, size, vector) with the nearest centre and the distance to it; vectors as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                some = batch.filter(pa.array(sizes == size))
                flat = some.column("vector").flatten().to_numpy(zero_copy_only=False)
                vectors = flat.astype("<f8").reshape(some.num_rows, size)
                points = lifted(vectors, norm)
                middles = centres.get(size, _pole(size, norm))
                cell = (points @ middles.T).argmax(axis=1)
                distance = _distances(points, middles[cell])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(some.column(n) for n in ("vec_id", "label", "size")),
                        pa.array([v.tobytes() for v in vectors], pa.binary()),
                        pa.array(cell.astype(np.int32)),
                        pa.array(distance),
                    ],
                    ["vec_id", "label", "size", "vector", "cell", "distance"],
                )

    return rows.mapInArrow(run, "vec_id long, label long, size int, vector binary, cell int, distance double")


def _pole(size: int, norm: float):
    """The image of the zero vector: the first centre of every size."""
    import numpy as np

    return np.eye(1, size + 1, size) * norm


def _centres(sample: list, norm: float, n_rows: int) -> dict:
    """Centres per size, from the sample; shared out by the rows of each size in it."""
    import numpy as np

    by_size: dict[int, list] = {}
    for row in sample:
        by_size.setdefault(len(row.vector), []).append(row.vector)
    found = {}
    for size, vectors in by_size.items():
        most = min(CELLS, -(-n_rows * len(vectors) // (SHARD * len(sample))))
        points = np.concatenate([_pole(size, norm), lifted(np.array(vectors, dtype=np.float64).reshape(len(vectors), size), norm)])
        chosen, _, _ = farthest_first(points, 0, 1 + most if most > 1 else 1, SLACK * norm)
        found[size] = points[chosen]
    return found


def _trees(cells: DataFrame, stats: DataFrame, norm: float) -> DataFrame:
    def build(key, rows):
        import numpy as np

        size = key[0].as_py()
        ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        vectors = matrix(rows["vector"].to_pylist(), size)
        tree = cover_tree(vectors, labels, ids, norm)
        order = tree.pop("order")
        tree |= {"ids": ids[order], "labels": labels[order], "vectors": vectors[order]}
        values = [*(k.as_py() for k in key)]
        for name in TREE_FIELDS[3:]:
            values.append(float(np.abs(vectors).max(initial=0.0)) if name == "largest" else np.ascontiguousarray(tree[name]).tobytes())
        return pa.table({n: [v] for n, v in zip(TREE_FIELDS, values)}).cast(
            pa.schema([("size", pa.int32()), ("cell", pa.int32()), ("salt", pa.int32())]
                      + [(n, pa.float64() if n == "largest" else pa.binary()) for n in TREE_FIELDS[3:]])
        )

    # At most CELLS rows and one more per length of vectors.
    salted = (
        cells.withColumn("row", F.monotonically_increasing_id())
        .join(F.broadcast(stats.select("size", "cell", "n_trees")), ["size", "cell"])
        .withColumn("salt", F.pmod(F.xxhash64("row"), F.col("n_trees")).cast("int"))
    )
    return salted.select(*PLACE, "vec_id", "label", "vector").groupBy(*PLACE).applyInArrow(build, TREE)


def _loaded(row: dict, norm: float) -> dict:
    size = row["size"]
    kinds = {"vectors": "<f8", "centres": "<f8", "radii": "<f8"}
    tree = {n: numbers(row[n], kinds.get(n, "<i8")) for n in TREE_FIELDS[3:] if n != "largest"}
    tree["vectors"] = tree["vectors"].reshape(len(tree["ids"]), size)
    tree["centres"] = tree["centres"].reshape(len(tree["radii"]), size)
    tree["begin"] = tree["begin"].reshape(-1, 2)
    return tree | {"largest": row["largest"], "norm": norm}


def _windows(positives: list[int]) -> list[tuple[int, int]]:
    return [(-(-LOW * s // 100), HIGH * s // 100) for s in positives]


def _window_arrays(rows: list[dict], same: bool):
    """Windows of some anchors as two arrays; where an anchor has fewer, nothing fits."""
    import numpy as np

    windows = [[(r["least"], FAR)] if same else _windows(r["positives"]) for r in rows]
    most = max(map(len, windows))
    least_of = [[w[0] for w in some] + [FAR] * (most - len(some)) for some in windows]
    most_of = [[w[1] for w in some] + [NONE] * (most - len(some)) for some in windows]
    return np.array(least_of, dtype=np.int64), np.array(most_of, dtype=np.int64)


def _routed(anchors: DataFrame, bounds: dict, norm: float, blocks: int, step: str) -> DataFrame:
    """Each anchor once per tree that may hold what it looks for.

    ``own``: positives in its own cell; ``others``: positives that beat ``least`` in other
    cells; ``negatives``: rows within the windows of ``positives``.
    """
    schema = pa.schema(
        [("size", pa.int32()), ("cell", pa.int32()), ("salt", pa.int32()), ("block", pa.int32()),
         ("anchor_id", pa.int64()), ("digest", pa.int64()), ("label", pa.int64()), ("vector", pa.binary()),
         ("least", pa.int64()), ("positives", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                size, label = r["size"], r["label"]
                cells, trees, middles, radii, low_label, high_label = bounds[size]
                q = numbers(r["vector"], "<f8")
                length = float(np.sqrt((q * q).sum()))
                spread = length * radii + SLACK * (length * norm + 1)
                middle = middles @ q
                if step == "own":
                    fits = cells == r["cell"]
                elif step == "others":
                    fits = (cells != r["cell"]) & (middle + spread >= r["least"])
                else:
                    fits = np.zeros(len(cells), dtype=bool)
                    for least, most in _windows(r["positives"]):
                        fits |= (middle + spread >= least) & (middle - spread <= most)
                    fits &= (low_label != label) | (high_label != label)
                if step != "negatives":
                    fits &= (low_label <= label) & (label <= high_label)
                block = r["digest"] % blocks
                for at in np.flatnonzero(fits).tolist():
                    for salt in range(int(trees[at])):
                        rows.append({**r, "cell": int(cells[at]), "salt": salt, "block": block})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return anchors.select("size", "cell", *ANCHOR, "label", "vector", "least", "positives").mapInArrow(
        run,
        "size int, cell int, salt int, block int, anchor_id long, digest long, label long, vector binary, "
        "least long, positives array<long>",
    )


def _searched(trees: DataFrame, routed: DataFrame, norm: float, blocks: int, same: bool) -> DataFrame:
    """(anchor_id, digest, place, found_id, score): the best of each tree, per window."""
    schema = pa.schema([(n, pa.int32() if n == "place" else pa.int64()) for n in (*ANCHOR, "place", "found_id", "score")])

    def run(left, right):
        import numpy as np

        parts = [schema.empty_table()]
        if left.num_rows and right.num_rows:
            # One tree and its anchors, both of bounded size.
            tree = _loaded(left.slice(0, 1).to_pylist()[0], norm)
            size = left["size"][0].as_py()
            for start in range(0, right.num_rows, CHUNK):
                rows = right.slice(start, CHUNK).to_pylist()
                least, most = _window_arrays(rows, same)
                own, digests, labels = (
                    np.array([r[n] for r in rows], dtype=np.int64) for n in (*ANCHOR, "label")
                )
                q = matrix([r["vector"] for r in rows], size)
                k = POSITIVES if same else NEGATIVES
                scores, ids = search(tree, q, labels, own, same, least, most, k)
                row, place, _ = at = np.nonzero(scores != NONE)
                columns = [own[row], digests[row], place.astype(np.int32), ids[at], scores[at]]
                parts.append(pa.table(dict(zip(schema.names, columns)), schema=schema))
        return pa.concat_tables(parts)

    copies = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    keys = [*PLACE, "block"]
    return (
        trees.select("*", copies)
        .groupBy(*keys)
        .cogroup(routed.groupBy(*keys))
        .applyInArrow(run, FOUND)
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` per anchor and place; ``rank`` from 1."""
    window = Window.partitionBy(*ANCHOR, "place").orderBy(F.col("score").desc(), "found_id")
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """``(vec_id, label, vector)`` of whole numbers -> one row per anchor, positive and negative.

    ``is_anchor`` is a condition on ``vec_id`` and ``label``. Result: ``anchor_id, positive_id,
    rank, negative_id, positive_score, negative_score``.

    Rows with a null id, label or vector, or a null or non-finite component take no
    part. Vectors of different length are not compared; empty vectors have score 0 with
    one another. A repeated anchor (same id, label and vector) is one anchor; other
    repeated rows are as many candidates. Rows with the anchor's own id are never its
    positives. Ties go to the smaller id. An anchor without positives, or without rows in
    a window, has no rows. Scores beyond 64 bits are held at their ends. Other columns are
    not read. An empty table gives no rows.
    """
    spark = rows.sparkSession
    vector = F.col("vector").cast("array<double>")
    usable = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("vector").isNotNull()
        & ~F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    )
    good = rows.where(F.coalesce(usable, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), vector.alias("vector")
    )
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    n_rows, largest = good.agg(F.count("*"), F.max(square)).first()
    norm = float(largest or 0.0) ** 0.5 * (1 + SLACK)
    step = max(1, n_rows // SAMPLE)
    drawn = good.where(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(step)) == 0).select("vector")
    centres = _centres(drawn.limit(2 * SAMPLE).collect(), norm, n_rows)

    sized = good.select("vec_id", "label", F.size("vector").alias("size"), "vector")
    cells = stored(_in_cells(sized, centres, norm), "cells")
    stats = (
        cells.groupBy("size", "cell")
        .agg(
            F.max("distance").alias("radius"),
            F.ceil(F.count("*") / SHARD).cast("int").alias("n_trees"),
            F.min("label").alias("low_label"),
            F.max("label").alias("high_label"),
        )
        .collect()
    )
    known = spark.createDataFrame(
        [(r["size"], r["cell"], r["n_trees"]) for r in stats], "size int, cell int, n_trees int"
    )
    bounds = _bounds(stats, centres, norm)
    trees = stored(_trees(cells, known, norm), "trees")

    anchors = stored(
        cells.where(is_anchor)
        .select("size", "cell", F.col("vec_id").alias("anchor_id"), "label", "vector")
        .withColumn("digest", F.xxhash64("label", "vector"))
        .dropDuplicates(ANCHOR),
        "anchors",
    )
    blocks = max(1, -(-anchors.count() // ANCHORS))
    lowest, none = F.lit(-FAR).alias("least"), F.lit(None).cast("array<long>").alias("positives")

    start = anchors.select("*", lowest, none)
    own = stored(_best(_searched(trees, _routed(start, bounds, norm, blocks, "own"), norm, blocks, True), POSITIVES), "own")
    fifth = own.where(F.col("rank") == POSITIVES).select(*ANCHOR, F.col("score").alias("fifth"))
    again = anchors.join(fifth, ANCHOR, "left").select(
        *anchors.columns, F.coalesce("fifth", F.lit(-FAR)).alias("least"), none
    )
    others = _searched(trees, _routed(again, bounds, norm, blocks, "others"), norm, blocks, True)
    positives = stored(_best(own.drop("rank").union(others), POSITIVES), "positives")

    listed = positives.groupBy(*ANCHOR).agg(
        F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("listed")
    )
    asked = anchors.join(listed, ANCHOR).select(*anchors.columns, lowest, F.col("listed.score").alias("positives"))
    found = _searched(trees, _routed(asked, bounds, norm, blocks, "negatives"), norm, blocks, False)
    of_positive = positives.select(
        *ANCHOR, (F.col("rank") - 1).alias("place"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return _best(found, NEGATIVES).join(of_positive, [*ANCHOR, "place"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("found_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _bounds(stats: list, centres: dict, norm: float) -> dict:
    """Per size: cells, number of trees, centres without the last component, radii, labels."""
    import numpy as np

    found = {}
    for size in {r["size"] for r in stats}:
        own = [r for r in stats if r["size"] == size]
        middles = centres.get(size, _pole(size, norm))
        found[size] = (
            np.array([r["cell"] for r in own]),
            np.array([r["n_trees"] for r in own]),
            np.array([middles[r["cell"]][:size] for r in own]).reshape(len(own), size),
            np.array([r["radius"] for r in own]),
            np.array([r["low_label"] for r in own]),
            np.array([r["high_label"] for r in own]),
        )
    return found
