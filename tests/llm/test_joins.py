"""Near-duplicate joins against all pairs, and the stages of the pipeline."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from newsloom.llm import components, embedding_dedup, jaccard_join


def united(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    draw = random.Random(1)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(draw.randint(100, 160), draw.randint(100, 160)) for _ in range(40)] + [(7, 7)]
    links = spark.createDataFrame(pairs, "a long, b long")
    expected = united({x for p in pairs for x in p}, pairs)
    found = {r.node: r.component for r in components.components(links).collect()}
    assert found == {n: c for n, c in expected.items() if n in found}
    assert all(n in found or n == c for n, c in expected.items() if n != 7)
    assert components.components(links.limit(0)).collect() == []


def sets(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").split()
    return {tuple(words[a : a + 5]) for a in range(max(1, len(words) - 4))} if words else set()


def test_jaccard_join(spark):
    draw, texts = random.Random(2), []
    for family in range(4):
        base = [f"w{family}x{draw.randint(0, 400)}" for _ in range(90)]
        for _ in range(30 if family == 0 else 8):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = f"n{draw.randint(0, 10**6)}"
            texts.append(" ".join(copy[: draw.choice([90, 90, 80, 72])]))
    shared = "this licence line stands in very many texts of all kinds and sources"
    texts += [shared + " " + " ".join(f"u{draw.randint(0, 10**6)}" for _ in range(draw.randint(0, 40))) for _ in range(40)]
    texts += [None, "", " \t ", "one two", "ONE\x0btwo", "one two three", texts[0], texts[0].upper(), "v " * 3000]
    rows = list(enumerate(texts, 10)) + [(None, texts[0]), (10, texts[0])]
    docs = spark.createDataFrame([(i, t, 0, 0, "x") for i, t in rows], "doc_id long, text string, n int, high int, region string")
    own = {i: sets(t) for i, t in rows if i is not None}
    ids = sorted(own)
    pairs = [
        (a, b) for a in ids for b in ids
        if a < b and own[a] and 100 * len(own[a] & own[b]) >= 80 * len(own[a] | own[b])
    ]
    expected = united(ids, pairs)
    found = jaccard_join.near_duplicates(docs.repartition(4)).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.n_shingles == len(own[10])
        else:
            assert (r.n_shingles, r.component_id) == (len(own[r.doc_id]), expected[r.doc_id])
    assert len(set(expected.values())) < len(ids) - 15
    assert jaccard_join.near_duplicates(docs.limit(0)).collect() == []


def test_jaccard_join_of_a_large_group(spark, monkeypatch):
    """Near copies of one text, many of them further apart than a link: few pairs of them leave a task."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    monkeypatch.setattr(jaccard_join, "PROFILE_BITS", (64, 1 << 16))
    sizes, taken = {}, jaccard_join.stored

    def counted(rows, name):
        found = taken(rows, name)
        sizes.setdefault(name, []).append(found.count())
        return found

    monkeypatch.setattr(jaccard_join, "stored", counted)
    draw, base = random.Random(4), [f"w{k}" for k in range(100)]
    texts = []
    for _ in range(120):
        copy = list(base)
        for place in draw.sample(range(100), draw.randint(1, 6)):
            copy[place] = f"n{draw.randint(0, 10**6)}"
        texts.append(" ".join(copy[: draw.choice([100, 95, 80])]))
    own = dict(enumerate(map(sets, texts)))
    pairs = [(a, b) for a in own for b in range(a) if 100 * len(own[a] & own[b]) >= 80 * len(own[a] | own[b])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(docs).collect()}
    assert found == united(own, pairs)
    # The last round is fed pairs that a profile of their own length allows, not all pairs of two classes.
    assert len(sizes["pairs"]) == 3 and sizes["pairs"][2] < 120 * 119 // 20


def test_words_leave_nothing_in_a_task():
    """What a task holds does not follow the number of different words it has seen."""

    class Rows:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    held = []

    def batches():
        for k in range(20):
            texts = [" ".join(f"w{k}x{n}x{i}" for i in range(500)) for n in range(10)]
            yield pa.RecordBatch.from_pydict({"doc_id": list(range(10)), "text": texts})
            held.append(tracemalloc.get_traced_memory()[0])

    for task in (jaccard_join._measured(Rows()), jaccard_join._windows(Rows(), np.arange(jaccard_join.BINS))):
        held.clear()
        tracemalloc.start()
        for _ in task(batches()):
            pass
        tracemalloc.stop()
        assert held[-1] - held[2] < 1 << 20


def test_profiles_bound_the_distance():
    draw = np.random.default_rng(8)
    for n, m in ((0, 5), (40, 40), (300, 900), (5000, 4500)):
        pool = draw.integers(0, 1 << 63, n + m, dtype=np.uint64)
        x, y = np.unique(pool[:n]), np.unique(np.concatenate([pool[: n // 2], pool[n : n + m - n // 2]]))
        apart = len(np.setxor1d(x, y))
        profiles = [jaccard_join._profile(v) for v in (x, y)]
        (found,) = jaccard_join._apart(profiles[:1], profiles[1:])
        assert found <= apart and jaccard_join._apart(profiles[:1], profiles[:1]).tolist() == [0]
        assert jaccard_join.Profiles(profiles).apart(profiles[0]).tolist() == [0, found]
        assert apart == 0 or found >= 0.4 * apart


def test_embedding_dedup(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 8)
    draw = np.random.default_rng(3)
    rows, centres = [], draw.standard_normal((6, 16))
    for i in range(120):
        noise = 0.03 * draw.standard_normal(16)
        rows.append((i, (centres[i % 6] + noise).tolist(), i % 2))
    same = centres[0].tolist()
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 3, [2.0] * 3]
    rows += [(200 + k, same, 0) for k in range(5)] + [(300 + k, v, 0) for k, v in enumerate(odd)]
    rows += [(400, same, None), (None, same, 0), (401, [3 * x for x in same], 0), (402, [-x for x in same], 0)]
    table = spark.createDataFrame([(*r, 0, "b") for r in rows], "vec_id long, embedding array<double>, label int, id int, bucket string")

    def good(r):
        v = r[1]
        return r[0] is not None and r[2] is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    usable = [r for r in rows if good(r)]
    pairs = []
    for k, a in enumerate(usable):
        for b in usable[:k]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    pairs.append((a[0], b[0]))
    ids = [r[0] for r in rows if r[0] is not None]
    expected = united(ids, pairs)
    links = {i: sum(i in p for p in pairs) for i in ids}
    assert len(pairs) > 500
    found = embedding_dedup.near_duplicates(table).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, False)
        else:
            assert (r.vec_id, r.n_links, r.component_id) == (r.vec_id, links[r.vec_id], expected[r.vec_id])
            assert r.kept == (r.vec_id == expected[r.vec_id])
    assert embedding_dedup.near_duplicates(table.limit(0)).collect() == []


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as pipeline

    item = " ".join(f"q{k}" for k in range(20))
    body = " ".join(f"b{k}" for k in range(60))
    rows = [
        (1, body, "en"), (2, body, "en"), (2, body, "en"), (3, f"x {item} y", "en"),
        (4, "mail me@here.org now", "en"), (None, "no id", None), (5, None, "de"), (6, "", None),
    ]
    docs = spark.createDataFrame(
        [(i, t, s, "s", len(t or ""), 1) for i, t, s in rows],
        "doc_id long, text string, lang string, source string, n_chars long, predicted int",
    )
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = docs
    seen = {}
    for name, stage in pipeline.STAGES:
        kept = stage(spark, kept, str(tmp_path))
        seen[name] = kept
        if name != pipeline.STAGES[-1][0]:
            assert kept.columns == docs.columns
    ids = {n: sorted((r.doc_id for r in d.select("doc_id").collect()), key=str) for n, d in seen.items()}
    assert len(ids["toxicity"]) == 8
    assert ids["jaccard_join"] == [1, 3, 4, 5, 6, None]
    assert ids["decontamination"] == ids["bpe"] == [1, 4, 5, 6, None]
    four = seen["personal_data"].where(F.col("doc_id") == 4).first()
    assert (four.text, four.n_chars) == ("mail [EMAIL] now", 16)


def test_shared_windows_are_dealt_out_once(spark):
    draw = random.Random(12)
    rows = [(draw.randint(-40, 40) * 7, draw.randint(0, 9)) for _ in range(120)] + [(5, k % 30) for k in range(300)]
    rows += [(1000 + k, k) for k in range(200)]
    windows = spark.createDataFrame(rows, "region long, high long").repartition(5)
    found = [tuple(r) for r in jaccard_join._shared(windows).collect()]
    several = {r for r, _ in rows if len({h for q, h in rows if q == r}) > 1}
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(found) == len(set(found)) and {x for x in rows if x[0] in several} <= set(found) <= set(rows)
    assert len({r for r, _ in found} - several) <= 2 * n
    plan = jaccard_join._shared(windows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan
    assert jaccard_join._shared(windows.limit(0)).collect() == []


def test_pipeline_stages_send_small_batches(spark, tmp_path):
    import corpus_pipeline as pipeline
    from newsloom import session

    docs = spark.createDataFrame([(1, "one text")], "doc_id long, text string")
    before = spark.conf.get(session.ARROW_SETTING)
    try:
        for _, stage in pipeline.STAGES[3:]:
            spark.conf.set(session.ARROW_SETTING, session.ARROW_DEFAULT)
            stage(spark, docs, str(tmp_path))
            assert spark.conf.get(session.ARROW_SETTING) == str(session.ARROW_BYTES)
    finally:
        spark.conf.set(session.ARROW_SETTING, before)


def test_rows_that_share_an_id_are_judged_each_for_itself(spark, tmp_path):
    import corpus_pipeline as pipeline

    body = " ".join(f"b{k}" for k in range(60))
    near = body + " x"
    other, long = " ".join(f"o{k}" for k in range(30)), "w " * 20_000
    rows = [(7, body), (7, other), (7, other), (3, near), (9, body), (9, None), (9, ""), (4, long), (5, long), (None, body)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, place int").repartition(3)
    found = pipeline.without_copies(spark, docs, str(tmp_path))
    assert found.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in found.collect()), key=str)
    assert kept == sorted([(3, near), (7, other), (9, None), (9, ""), (4, long), (None, body)], key=str)
    assert pipeline.without_copies(spark, docs.limit(0), str(tmp_path)).collect() == []
