"""Catchphrases against every run of every length."""

import pathlib
import random

import pytest

from newsloom.operators import fusion, lexical, runs


def plain(texts, least, longest, most):
    found = {}
    for key, text in texts:
        said = text.lower().split()
        runs = {tuple(said[a : a + n]) for n in range(2, longest + 1) for a in range(len(said) - n + 1)}
        for run in runs:
            found[key, run] = found.get((key, run), 0) + 1
    kept = {k: n for k, n in found.items() if n >= least}
    gone = set()
    for (key, run), n in kept.items():
        for part in (run[1:], run[:-1]):
            if kept.get((key, part)) == n:
                gone.add((key, part))
    out = []
    for key in {k for k, _ in kept}:
        mine = [(-n, -len(run), " ".join(run)) for (k, run), n in kept.items() if k == key and (k, run) not in gone]
        out += [(key, phrase, -length, -n, place) for place, (n, length, phrase) in enumerate(sorted(mine)[:most], 1)]
    return sorted(out)


@pytest.mark.parametrize("least, longest, most", [(2, 6, 1000), (3, 4, 5), (1, 3, 1000), (50, 6, 10)])
def test_phrases(spark, least, longest, most):
    draw = random.Random(11)
    fixed = ["no fim das contas", "Vamos que vamos gente", "é o que é"]
    texts = []
    for _ in range(60):
        said = [draw.choice(["a", "b", "c", "d", "casa", "Rua"]) for _ in range(draw.randint(0, 9))]
        said.insert(draw.randint(0, len(said)), draw.choice(fixed + [""]))
        texts.append((draw.choice("xy"), " ".join(w for w in said if w)))
    texts += [("z", ""), ("z", "one"), ("x", texts[0][1])]
    table = spark.createDataFrame([(*t, 1) for t in texts], "corpus_key string, text string, place int").repartition(3)
    found = lexical.catchphrases(table, least, longest, most)
    assert sorted(tuple(r) for r in found.collect()) == plain(texts, least, longest, most)


def test_books_hold_catchphrases(spark):
    texts = [("k", 1, "E aí, meu povo! Vamos lá"), ("k", 2, "e aí meu povo"), ("k", 3, "olha só e aí meu povo"), ("k", 4, "povo")]
    blocks = spark.createDataFrame(texts, "corpus_key string, block_no long, text string")
    phrases = lexical.catchphrases(blocks, 3)
    assert [(r.phrase, r.texts) for r in phrases.collect()] == [("e aí meu povo", 3)]
    ranked = fusion.ranked_items(lexical.lexical_analyses(blocks, phrases=phrases))
    found = [(r.key, r.recurrence) for r in ranked.where("list = 'bordoes'").collect()]
    assert found == [("e aí meu povo", 3)]
    nothing = lexical.catchphrases(blocks.limit(0), 3)
    assert nothing.collect() == []


def test_all_lengths_are_counted_at_once(spark, monkeypatch):
    rows = [("c", f"a b c d {'e' * k}") for k in range(1, 4)] + [("c", None), ("d", "a b c d")]
    texts = spark.createDataFrame(rows, "corpus_key string, text string")
    names = []
    monkeypatch.setattr(lexical, "stored", lambda frame, name: names.append(name) or frame)
    found = lexical.catchphrases(texts, 3, 4, 50)
    assert names == ["recurrent"]
    assert [(r.corpus_key, r.phrase, r.texts) for r in found.collect()] == [("c", "a b c d", 3)]


def _shuffled(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(p.stat().st_size for f in folders for p in pathlib.Path(f).rglob("shuffle_*.data"))


def test_runs_of_rare_words_take_no_disk(spark):
    draw = random.Random(5)
    rare = [f"{draw.getrandbits(28):07x}" for _ in range(5000)]
    texts = [("c", " ".join([*draw.choices(rare, k=150), "no fim das contas gente", *draw.choices(rare, k=150)])) for _ in range(400)]
    table = spark.createDataFrame(texts, "corpus_key string, text string").repartition(3).localCheckpoint()
    before = _shuffled(spark)
    found = [(r.phrase, r.texts) for r in lexical.catchphrases(table, 3, 5, 1).collect()]
    assert found == [("no fim das contas gente", 400)]
    assert _shuffled(spark) - before < sum(len(t) for _, t in texts)


@pytest.mark.parametrize("least, longest, most", [(2, 4, 3), (3, 6, 2), (1, 2, 4), (2, 5, 1)])
def test_the_bound_of_a_corpus_loses_no_phrase(spark, least, longest, most):
    draw = random.Random(least * 100 + longest)
    names = [f"w{k}" for k in range(60)]
    often = [1 / (k + 1) for k in range(60)]
    texts = [("large", " ".join(draw.choices(names, often, k=draw.randint(0, 40)))) for _ in range(120)]
    texts += [("small", " ".join(draw.choices(names, often, k=6))) for _ in range(5)] + [("large", "x y z x y z")] * 30
    table = spark.createDataFrame(texts, "corpus_key string, text string").repartition(3)
    found = lexical.catchphrases(table, least, longest, most)
    assert sorted(tuple(r) for r in found.collect()) == plain(texts, least, longest, most)


@pytest.mark.parametrize("kind, keys", [("string", ["é", None]), ("long", [-3, None])])
def test_marked_words_of_a_corpus(spark, kind, keys):
    said = [(keys[0], ["a", "ü", "b", "a", "ü"]), (keys[1], ["a", "ü", "c"]), (keys[1], []), (keys[0], ["ü", "b"])]
    spoken = spark.createDataFrame(said, f"corpus_key {kind}, said array<string>").repartition(2)
    some = spark.createDataFrame([(keys[0], "a"), (keys[0], "ü"), (keys[1], "c"), (keys[1], "a")], f"corpus_key {kind}, run string")
    found = runs.counted(spoken, [1, 2], runs.marks(some))
    expected = {(keys[0], "a", 1), (keys[0], "ü", 2), (keys[0], "a ü", 1), (keys[1], "a", 1), (keys[1], "c", 1)}
    assert sorted(map(str, {tuple(r) for r in found.collect()})) == sorted(map(str, expected))
    assert runs.counted(spoken, [1], runs.marks(some.limit(0))).collect() == []
