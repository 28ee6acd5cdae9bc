"""Near-duplicate vectors by p-stable hashing and exact cosine checks.

A normalised vector is projected on random Gaussian directions; for a Gaussian
(2-stable) direction the difference of two projections is normal with the
Euclidean distance of the vectors as deviation. Projections, shifted and cut
into steps, make a bucket key per table. A cosine of 0.98 is a distance of 0.2:
such a pair shares the bucket of one table with probability 0.33, and at least
one of 20 tables with 0.9997; closer pairs more surely.

Vectors of a bucket are compared in blocks of bounded size. A pair counts in the
first table that brings it together, so links can be summed up without any list
of pairs, and each block returns only links per vector and which vectors it ties.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import runs
from newsloom.llm.components import components
from newsloom.session import stored

MIN_COSINE = 0.98
TABLES = 20
#: Directions per table and width of a step, the vectors having length 1.
DIRECTIONS = 16
STEP = 2.4
SEED = 20260101
#: Vectors of a block; a bucket of more is compared block by block.
BLOCK = 400


def _projections(size: int):
    import numpy as np

    draw = np.random.default_rng([SEED, size])
    total = TABLES * DIRECTIONS
    return draw.standard_normal((size, total)), draw.uniform(0, 1, total)


def unit(vectors):
    """Rows of length 1, in double precision."""
    import numpy as np

    # Scaled first, so that squares of very large or small components stay finite.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def bucket_keys(units):
    """A 64-bit key per row and table."""
    import numpy as np
    import xxhash

    directions, shifts = _projections(units.shape[1])
    steps = np.floor(units @ directions / STEP + shifts).astype("<i4")
    steps = steps.reshape(len(units), TABLES, DIRECTIONS)
    keys = [
        [xxhash.xxh64_intdigest(steps[i, t].tobytes(), seed=t) for t in range(TABLES)] for i in range(len(units))
    ]
    return np.array(keys, dtype=np.uint64).reshape(len(units), TABLES).view(np.int64)


def _matrix(column):
    """Equally long vectors as a matrix of doubles."""
    import numpy as np

    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _hashed(vectors: DataFrame) -> DataFrame:
    """(id, label, vector) -> (id, label, size, bucket) for each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                some = batch.filter(pa.array(sizes == size))
                for a in range(0, some.num_rows, 4096):
                    part = some.slice(a, 4096)
                    keys = bucket_keys(unit(_matrix(part.column("vector"))))
                    n = part.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(part.column("id").to_numpy(), TABLES)),
                            pa.array(np.repeat(part.column("label").to_numpy(), TABLES)),
                            pa.array(np.full(n * TABLES, size, dtype=np.int32)),
                            pa.array(np.tile(np.arange(TABLES, dtype=np.int32), n)),
                            pa.array(keys.ravel()),
                        ],
                        ["id", "label", "size", "table", "bucket"],
                    )

    return vectors.mapInArrow(run, "id long, label long, size int, table int, bucket long")


def _linked_in_blocks(rows: DataFrame) -> DataFrame:
    """Rows of blocks to be compared -> (id, links, tied): links first found here, least id tied to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for run_ in runs(batches, ["task"]):
            ids, copies = run_["id"].to_numpy(), run_["copies"].to_numpy()
            sides, table = run_["side"].to_numpy(), run_["table"][0].as_py()
            if len(ids) < 2:
                continue
            units = unit(_matrix(run_["vector"]))
            keys = bucket_keys(units)
            first, second = np.flatnonzero(sides != 1), np.flatnonzero(sides != 0)
            linked = units[first] @ units[second].T >= MIN_COSINE
            # Buckets are keyed by hash: the key of this table must agree, none of an earlier one.
            linked &= keys[first, table][:, None] == keys[second, table][None, :]
            for t in range(table):
                linked &= keys[first, t][:, None] != keys[second, t][None, :]
            if (sides == 2).all():
                np.fill_diagonal(linked, False)
            if not linked.any():
                continue
            links = np.zeros(len(ids), dtype=np.int64)
            links[first] += linked @ copies[second]
            if not (sides == 2).all():
                links[second] += linked.T @ copies[first]
            tied = ids.copy()
            while True:
                before = tied.copy()
                # Least id over each row's and each column's links, until nothing moves.
                far = np.iinfo(np.int64).max
                low = np.where(linked, tied[second][None, :], far).min(axis=1)
                tied[first] = np.minimum(tied[first], low)
                low = np.where(linked, tied[first][:, None], far).min(axis=0)
                tied[second] = np.minimum(tied[second], low)
                if (tied == before).all():
                    break
            some = links > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[some]), pa.array(links[some]), pa.array(tied[some])], ["id", "links", "tied"]
            )

    return rows.mapInArrow(run, "id long, links long, tied long")


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding, label) -> one row per vector row: vec_id, n_links, component_id, kept.

    Vectors link when their labels are equal and not null, they have the same
    length, and their cosine is at least 0.98. A vector that is null, empty,
    zero, or holds a null or non-finite component links with nothing, nor does a
    row with a null id (its component is null, ``kept`` false). Equal vectors are
    compared once and counted as often as they occur; a repeated id is as many
    vectors and one node. An empty table gives no rows.
    """
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    good = (
        F.col("id").isNotNull()
        & F.col("label").isNotNull()
        & (F.size("vector") > 0)
        & ~F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        & F.exists("vector", lambda v: v != 0)
    )
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    rows = rows.withColumn("high", F.when(F.col("good"), F.xxhash64("label", "vector")))
    rows = rows.withColumn("low", F.when(F.col("good"), F.xxhash64(F.lit(SEED), "vector", "label")))
    known = rows.where("good")
    distinct = stored(
        known.groupBy("high", "low").agg(
            F.min("id").alias("id"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector")
        ),
        "vectors",
    ).withColumn("size", F.size("vector"))
    # Two different vectors under one id keep apart by their digests.
    distinct = distinct.withColumn("node", F.col("id")).withColumn("id", F.col("high"))

    hashed = stored(_hashed(distinct.select("id", "label", "size", "vector")), "buckets")
    place = ["label", "size", "table", "bucket"]
    full = hashed.groupBy(*place).agg(F.count("*").alias("n")).where("n > 1")
    members = hashed.join(stored(full, "full"), place)
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    members = members.select(
        "id", *place, blocks.alias("blocks"), F.pmod(F.xxhash64("id"), blocks).cast("int").alias("own")
    )
    # Block i meets block j for i <= j: as first side (0), second side (1), or with itself (2).
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    members = members.select(
        "id",
        "table",
        F.xxhash64(*place, low, high).alias("task"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    payload = members.join(distinct.select("id", "copies", "vector"), "id")
    n = int(embeddings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = payload.repartition(n, "task").sortWithinPartitions("task", "side", "id")
    found = stored(_linked_in_blocks(tasks), "found")

    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    ties = found.where("id <> tied").select(F.col("id").alias("a"), F.col("tied").alias("b")).distinct()
    # Components over least vec_ids; nodes of one id are one.
    names = distinct.select("id", "node")
    ties = (
        ties.join(names.select(F.col("id").alias("a"), F.col("node").alias("na")), "a")
        .join(names.select(F.col("id").alias("b"), F.col("node").alias("nb")), "b")
        .select(F.col("na").alias("a"), F.col("nb").alias("b"))
    )
    tied = stored(components(ties), "tied")
    classes = (
        distinct.select("high", "low", "id", "node", "copies")
        .join(links, "id", "left")
        .join(tied.withColumnRenamed("component", "least"), "node", "left")
        .select(
            "high",
            "low",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("least", "node").alias("component_id"),
        )
    )
    return (
        rows.select("id", "high", "low")
        .join(stored(classes, "classes"), ["high", "low"], "left")
        .select(
            F.col("id").alias("vec_id"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
