"""Line dedup, filter audit and hard negatives against plain Python on small tables."""

import hashlib
import itertools
import os
import random

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

from newsloom.llm import filter_audit, hard_negatives, line_dedup
from newsloom.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    assert oracle.differences(spark, oracle.duck(SF_DIR), SF_DIR, QUERIES[name], SQL[name]) is None


# ---- lines ---------------------------------------------------------------------


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def without(texts, least_documents, least_chars=1):
    split = [(t or "").split("\n") for t in texts]
    counts = {}
    for lines in split:
        for k in {key(x) for x in lines}:
            counts[k] = counts.get(k, 0) + 1
    gone = {k for k, n in counts.items() if n >= least_documents and len(k) >= least_chars}
    kept = [[x for x in lines if key(x) not in gone] for lines in split]
    return sorted(("\n".join(k), len(s), len(s) - len(k)) for k, s in zip(kept, split))


def line_texts():
    draw = random.Random(4)
    pool = ["Menu", " menu\t", "MENU\x0b", "É", "é", "", " \r", "İ", "\x1c", "a b", "A  b", "\U0001f600 x"]
    texts = ["\n".join(draw.choice(pool) for _ in range(draw.randint(1, 7))) for _ in range(60)]
    long = "\n".join(f"line {k}" if k % 3 else "menu" for k in range(5000))
    return texts + [None, "", "\n", "menu", "menu\nmenu\nmenu", "z" * 200_000, long, long]


def line_rows(spark, texts):
    rows = [(i if i % 9 else None, t, 0, "p", "h") for i, t in enumerate(texts)]
    rows = [(7 if i == 8 else i, *r) for i, *r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, position int, line string, high string")


@pytest.mark.parametrize("least", [1, 3, 10, 200])
def test_lines(spark, least):
    texts = line_texts()
    found = line_dedup.without_frequent_lines(line_rows(spark, texts).repartition(5), least).collect()
    assert sorted((r.text, r.n_lines, r.n_dropped) for r in found) == without(texts, least)


def test_lines_of_some_length_only(spark):
    texts = ["ab\nc\n\nab"] * 3 + ["abc"]
    found = line_dedup.without_frequent_lines(line_rows(spark, texts), 3, 2).collect()
    assert sorted((r.text, r.n_lines, r.n_dropped) for r in found) == without(texts, 3, 2)
    assert found[0].n_lines in (1, 4)


def test_lines_of_nothing(spark):
    rows = line_rows(spark, ["x"]).limit(0)
    assert line_dedup.without_frequent_lines(rows).collect() == []


def test_no_python_in_the_plan(spark):
    found = line_dedup.without_frequent_lines(line_rows(spark, ["a"]))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- filters --------------------------------------------------------------------


def test_intervals_cover_every_order_and_mask_once():
    orders = filter_audit.orders()
    assert orders == sorted(orders) and len(set(orders)) == 120
    found = {}
    for mask, step, outcome, begin, end in filter_audit.rank_intervals():
        assert begin < end
        for rank in range(begin, end):
            assert found.setdefault((mask, step, rank), outcome) == outcome
    for mask, step, (rank, order) in itertools.product(range(32), range(1, 6), enumerate(orders)):
        bits = [mask >> "ABCDE".index(c) & 1 for c in order]
        expected = None
        if bits[step - 1]:
            expected = "redundant" if any(bits[: step - 1]) else "removed"
        elif not any(bits[: step - 1]):
            expected = "kept"
        assert found.get((mask, step, rank)) == expected


def failed(text):
    words = [w for w in "".join(" " if c in BLANKS else c for c in text).split(" ") if w]
    letters = ""
    if len(words) < 200:
        letters += "A"
    if 100 * len(set(words)) < 50 * len(words):
        letters += "B"
    if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text):
        letters += "C"
    if any(c in "#$%&*|" for c in text):
        letters += "D"
    return letters


def run_orders(docs, labels):
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    marked = []
    for i, text, source in docs:
        text = text or ""
        copy = i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs)
        marked.append((source or "", set(failed(text)) | ({"E"} if copy else set()), i in good, i in toxic))
    rows = {}
    for part, order in itertools.product({m[0] for m in marked}, itertools.permutations("ABCDE")):
        left = [m for m in marked if m[0] == part]
        for step, letter in enumerate(order, 1):
            out = [m for m in left if letter in m[1]]
            left = [m for m in left if letter not in m[1]]
            fails = [m for m in marked if m[0] == part and letter in m[1]]
            rows[part, "".join(order), step] = [
                len(left), len(out), len(fails) - len(out), sum(m[1] == {letter} for m in fails),
                sum(m[2] for m in out), sum(m[3] for m in out),
            ]
    shapley = {}
    for (part, order, step), values in rows.items():
        at = part, order[step - 1]
        shapley[at] = shapley.get(at, 0) + values[1]
    return {k: [*v, shapley[k[0], k[1][k[2] - 1]]] for k, v in rows.items()}


def test_filters(spark):
    draw = random.Random(5)
    texts = [None, "", "x", "x", "#", "ABC def", "é " * 300, "w " * 30_000, "\x0b\x0c \r\n\t", "\x1c a"]
    for _ in range(60):
        n = draw.choice([3, 150, 199, 200, 201, 260])
        words = [f"w{draw.randint(0, draw.choice([40, 99, 100, 900]))}" for _ in range(n)]
        if draw.random() < 0.3:
            words += ["ABCDE"] * draw.randint(0, 6)
        texts.append(draw.choice([" ", "\t", "\x0b  "]).join(words) + draw.choice(["", "", "|", " "]))
    texts += [draw.choice(texts) for _ in range(40)]
    docs = [(i if i % 11 else None, t, draw.choice(["a", "b", None, ""])) for i, t in enumerate(texts)]
    docs += [docs[3], (3, "other", "a"), (-5, texts[20], "b")]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i in range(0, 80, 2)]
    labels += [(None, 1, 1), (4, 1, 1), (4, 0, 0), (9999, 1, 1)]
    documents = spark.createDataFrame(
        [(*d, 1, "m") for d in docs], "doc_id long, text string, source string, mask int, part string"
    )
    table = spark.createDataFrame([(*x, 0) for x in labels], "doc_id long, quality int, toxic int, n int")
    found = filter_audit.audit(documents.repartition(3), table).collect()
    counts = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r.part, r.filter_order, r.step): [r[c] for c in counts] for r in found} == run_orders(docs, labels)
    assert len(found) == 600 * 3
    assert filter_audit.audit(documents.limit(0), table).collect() == []
    assert len(filter_audit.audit(documents, table.limit(0)).collect()) == 600 * 3


# ---- hard negatives ---------------------------------------------------------------


def mined(rows, is_anchor):
    good = [
        r for r in rows
        if r[0] is not None and r[1] is not None and r[2] is not None
        and all(x is not None and np.isfinite(x) for x in r[2])
    ]
    found = []
    for a in {(r[0], r[1], tuple(r[2])) for r in good if is_anchor(r[0])}:
        scored = [(-int(sum(int(x) * int(y) for x, y in zip(a[2], r[2]))), r[0], r[1]) for r in good if len(r[2]) == len(a[2])]
        positives = sorted(s for s in scored if s[2] == a[1] and s[1] != a[0])[:5]
        for score, positive, _ in positives:
            fits = sorted(s for s in scored if s[2] != a[1] and 30 * -score <= 100 * -s[0] <= 90 * -score)[:10]
            found += [(a[0], positive, k, s[1], -score, -s[0]) for k, s in enumerate(fits, 1)]
    return sorted(found)


def rows_of(table):
    return sorted(tuple(r) for r in table.collect())


def test_hard_negatives(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "SHARD", 40)
    monkeypatch.setattr(hard_negatives, "LEAF", 6)
    monkeypatch.setattr(hard_negatives, "FAN", 4)
    monkeypatch.setattr(hard_negatives, "CHILD", 2)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    draw = np.random.default_rng(6)
    centres = draw.standard_normal((5, 8))
    rows = [
        (i, int(draw.integers(0, 4)), np.floor(256 * (centres[i % 5] + 0.4 * draw.standard_normal(8))).tolist())
        for i in range(400)
    ]
    same = rows[10][2]
    rows += [(500 + k, k % 2, same) for k in range(120)]  # a hot vector
    rows += [rows[10], (10, 3, same), (20, 1, rows[21][2]), (30, 2, [0.0] * 8), (31, 2, [0.0] * 8), (32, 1, [0.0] * 8)]
    rows += [(40, 1, [1.0, 2.0]), (50, 1, [2.0, 2.0]), (51, 0, [1.0, 1.0]), (60, 0, []), (61, 0, []), (62, 1, [])]
    odd = [None, [None] * 8, [float("nan")] * 8, [float("inf")] * 8]
    rows += [(700 + k, 1, v) for k, v in enumerate(odd)] + [(None, 1, same), (800, None, same)]
    table = spark.createDataFrame(
        [(*r, 0, "x") for r in rows], "vec_id long, label long, vector array<double>, size int, cell string"
    ).repartition(3)
    expected = mined(rows, lambda i: i % 10 == 0)
    assert len(expected) > 500
    assert rows_of(hard_negatives.hard_negatives(table, F.col("vec_id") % 10 == 0)) == expected
    nothing = hard_negatives.hard_negatives(table.limit(0), F.col("vec_id") % 10 == 0)
    assert nothing.collect() == []


def test_hard_negatives_of_very_large_numbers(spark):
    rows = [(k, k % 2, [float(2**40 + k), -float(2**35 + 3 * k)]) for k in range(12)]
    rows += [(100, 0, [3e38, 1.0]), (101, 0, [3e38, 2.0]), (102, 1, [1e38, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, label long, vector array<double>")
    found = rows_of(hard_negatives.hard_negatives(table, F.col("vec_id") <= 5))
    assert {r[0] for r in found} <= set(range(6))


def test_tree_radii_hold_their_rows():
    draw = np.random.default_rng(7)
    vectors = np.floor(256 * np.concatenate([draw.standard_normal((900, 5)), np.ones((300, 5))]))
    norm = float(np.sqrt((vectors**2).sum(axis=1)).max())
    ids = draw.permutation(1200)
    tree = hard_negatives.cover_tree(vectors, np.arange(1200) % 3, ids, norm)
    placed = vectors[tree["order"]]
    assert sum(tree["n_children"] > 0) >= 1
    assert sorted(tree["order"].tolist()) == list(range(1200))
    for node, (a, b) in enumerate(tree["begin"]):
        middle = hard_negatives.lifted(tree["centres"][node : node + 1], norm)
        gaps = np.sqrt(((hard_negatives.lifted(placed[a:b], norm) - middle) ** 2).sum(axis=1))
        assert gaps.max() <= tree["radii"][node] + 1e-6 * norm
        if tree["n_children"][node]:
            first = tree["first"][node]
            inner = tree["begin"][first : first + tree["n_children"][node]]
            assert inner[0][0] == a and inner[-1][1] == b
            assert (inner[1:, 0] == inner[:-1, 1]).all()
        else:
            assert (np.diff(ids[tree["order"][a:b]]) > 0).all()


def test_digests_name_kept_lines(spark):
    text = "a\n b \nA"
    found = line_dedup.without_frequent_lines(line_rows(spark, [text]), 1).select(F.sha2("text", 256)).first()
    assert found[0] == hashlib.sha256(b"").hexdigest()
