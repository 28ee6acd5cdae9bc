"""How document filters act together, over every order in which they may run.

Five filters have 120 orders; in lexicographic order each has a rank (its Lehmer
code read as a number). What a document does in an order depends only on its
mask, the set of filters it fails: it goes at the first filter of the order that
is in the mask. All orders that begin with the same letters have neighbouring
ranks, so what a mask does at a step holds on a few intervals of ranks.

Documents are counted per part and mask. The counts are added at the first rank of
each interval and taken off behind its last; a running sum over the 120 ranks
then gives every order at once, and no document is looked at per order.
"""

from __future__ import annotations

import itertools
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LETTERS = "ABCDE"
ORDERS = factorial(len(LETTERS))
#: Fixed values of the filters.
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 2
MARKUP = r"[#$%&*|]"
BLANK = r"[\x20\x09-\x0D]+"
BLANKS = "".join(map(chr, [0x20, *range(0x09, 0x0E)]))
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What is counted of the documents of a mask, and what of it each outcome adds up.
COUNTS = ["n", "good", "toxic"]
SEED = 13


def failed_by_text(text: Column) -> Column:
    """The mask of filters A to D (bits 1, 2, 4, 8) of a text that is not null."""
    bare = F.btrim(text, F.lit(BLANKS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK, -1))
    sizes = F.transform(
        F.array(words),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n"), F.size(F.array_distinct(w)).cast("long").alias("distinct")
        ),
    )[0]
    capitals = (F.length(text) - F.length(F.translate(text, CAPITALS, ""))).cast("long")
    of_words = F.transform(
        F.array(sizes),
        lambda s: F.when(s["n"] < LEAST_WORDS, 1).otherwise(0)
        + F.when(100 * s["distinct"] < LEAST_DISTINCT_PERCENT * s["n"], 2).otherwise(0),
    )[0]
    return (
        of_words
        + F.when(100 * capitals > MOST_CAPITALS_PERCENT * F.length(text).cast("long"), 4).otherwise(0)
        + F.when(F.regexp_like(text, F.lit(MARKUP)), 8).otherwise(0)
    )


def masks(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents per ``(part, mask)``: ``n``, and those labelled ``good`` and ``toxic``.

    A copy is told by meeting its text's least id on (digest, id): the ids of a
    group of copies are spread over all tasks, however large the group.
    """
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        "doc_id",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.xxhash64(text).alias("high"),
        F.xxhash64(F.lit(SEED), text).alias("low"),
        failed_by_text(text).alias("failed"),
    )
    firsts = (
        documents.select("doc_id", F.xxhash64(text).alias("high"), F.xxhash64(F.lit(SEED), text).alias("low"))
        .where("doc_id IS NOT NULL")
        .groupBy("high", "low")
        .agg(F.min("doc_id").alias("doc_id"))
        .withColumn("first", F.lit(True))
    )
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("long"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("long"), F.lit(0))).alias("toxic"),
    )
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return (
        rows.join(firsts, ["high", "low", "doc_id"], "left")
        .join(known, "doc_id", "left")
        .select(
            "part",
            (F.col("failed") + F.when(copy, 16).otherwise(0)).alias("mask"),
            F.coalesce("good", F.lit(0)).alias("good"),
            F.coalesce("toxic", F.lit(0)).alias("toxic"),
        )
        .groupBy("part", "mask")
        .agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    )


def orders() -> list[str]:
    """All orders; the place of one is its rank."""
    return ["".join(p) for p in itertools.permutations(LETTERS)]


def rank_intervals() -> list[tuple[int, int, str, int, int]]:
    """``(mask, step, outcome, first rank, rank behind the last)``, neighbours joined.

    Outcomes of a mask at a step: ``kept`` when no letter up to it is in the mask,
    ``removed`` when its own is and none before, ``redundant`` when its own is and
    one before as well.
    """
    found: dict[tuple[int, int, str], list[list[int]]] = {}
    size = len(LETTERS)
    for step in range(1, size + 1):
        width = factorial(size - step)
        for place, letters in enumerate(itertools.permutations(range(size), step)):
            begin = place * width
            for mask in range(1 << size):
                earlier = any(mask >> k & 1 for k in letters[:-1])
                here = mask >> letters[-1] & 1
                if here:
                    outcome = "redundant" if earlier else "removed"
                elif not earlier:
                    outcome = "kept"
                else:
                    continue
                spans = found.setdefault((mask, step, outcome), [])
                if spans and spans[-1][1] == begin:
                    spans[-1][1] = begin + width
                else:
                    spans.append([begin, begin + width])
    return [(*key, a, b) for key, spans in found.items() for a, b in spans]


def _ends(spark: SparkSession) -> DataFrame:
    """``(mask, step, rank, kept, removed, redundant)``: +1 where an interval begins, -1 behind it."""
    signs: dict[tuple[int, int, int], dict[str, int]] = {}
    for mask, step, outcome, begin, end in rank_intervals():
        for rank, sign in ((begin, 1), (end, -1)):
            if rank < ORDERS:
                at = signs.setdefault((mask, step, rank), {"kept": 0, "removed": 0, "redundant": 0})
                at[outcome] += sign
    rows = [(*key, at["kept"], at["removed"], at["redundant"]) for key, at in signs.items()]
    return spark.createDataFrame(
        rows, "mask int, step int, rank int, kept int, removed int, redundant int"
    )


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents(doc_id, text, source)``, ``labels(doc_id, quality, toxic)`` -> one row per
    part, order and step, zeros included: ``part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley``.

    A row is a document. A null text is empty, a null source the part ``''``. Filter E
    fails rows whose text a smaller id has; rows of one id do not fail one another, and
    a row without an id neither fails E nor makes others fail. A label holds when any of the
    document's label rows gives it; labels without an id, null labels, and documents
    without labels count for nothing. Long texts are held one at a time. Other columns
    are not read. An empty table has no part and gives no rows.
    """
    spark = documents.sparkSession
    counts = masks(documents, labels)
    # 600 rows per part at most, whatever the data; the fixed table has under 4,000 rows.
    ends = F.broadcast(_ends(spark))
    changes = counts.join(ends, "mask").groupBy("part", "step", "rank").agg(
        F.sum(F.col("kept") * F.col("n")).alias("kept"),
        F.sum(F.col("removed") * F.col("n")).alias("removed"),
        F.sum(F.col("redundant") * F.col("n")).alias("redundant"),
        F.sum(F.col("removed") * F.col("good")).alias("good_lost"),
        F.sum(F.col("removed") * F.col("toxic")).alias("toxic_lost"),
    )
    single = [F.sum(F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(0)) for k in range(len(LETTERS))]
    parts = counts.groupBy("part").agg(F.array(*single).alias("only"))
    names = F.broadcast(
        spark.createDataFrame(list(enumerate(orders())), "rank int, filter_order string")
    )
    places = F.explode(F.sequence(F.lit(0), F.lit(ORDERS * len(LETTERS) - 1))).alias("place")
    every = (
        parts.select("part", "only", places)
        .select(
            "part",
            "only",
            F.floor(F.col("place") / len(LETTERS)).cast("int").alias("rank"),
            (F.col("place") % len(LETTERS) + 1).alias("step"),
        )
        .join(names, "rank")
    )
    so_far = (
        Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    )
    sums = ["kept", "removed", "redundant", "good_lost", "toxic_lost"]
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    totals = every.join(changes, ["part", "step", "rank"], "left").select(
        "part",
        "filter_order",
        "step",
        letter.alias("letter"),
        F.element_at("only", F.instr(F.lit(LETTERS), letter)).alias("unique_fails"),
        *[F.sum(F.coalesce(c, F.lit(0))).over(so_far).alias(c) for c in sums],
    )
    of_letter = Window.partitionBy("part", "letter")
    return totals.select(
        "part",
        "filter_order",
        "step",
        "kept",
        "removed",
        "redundant",
        "unique_fails",
        "good_lost",
        "toxic_lost",
        F.sum("removed").over(of_letter).alias("shapley"),
    )
