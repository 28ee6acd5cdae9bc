"""Corpora and blocks against a plain restatement."""

import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators import corpus


def joined(texts):
    return "\n\n".join(text for _, text in sorted(texts)).strip()


def restated(text, limit):
    found, block, size = [], [], 0
    for line in text.splitlines():
        if block and size + len(line) > limit:
            found.append("\n".join(block))
            block, size = [], 0
        block.append(line)
        size += len(line)
    return found + ["\n".join(block)] if block else found


def frame(spark, corpora):
    rows = [(key, name, text) for key, texts in corpora.items() for name, text in texts]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(
        rows, "corpus_key string, file_name string, text string"
    ).repartition(3)


def found(rows):
    out = {}
    for row in rows.collect():
        out.setdefault(row.corpus_key, {})[row.block_no] = row.text
    return {key: [blocks[n + 1] for n in range(len(blocks))] for key, blocks in out.items()}


def test_small_case(spark):
    texts = {"k": [("f", "aaaa\nbbbb\n\ncccccccccccc\nd")]}
    assert found(corpus.blocks(frame(spark, texts), 8, partitions=2)) == {
        "k": ["aaaa\nbbbb\n", "cccccccccccc", "d"]
    }


def test_blank_ends_and_blank_corpora(spark):
    texts = {
        "a": [("1", " \n"), ("2", "\n x\n"), ("3", ""), ("4", "y \n\n"), ("5", " ")],
        "b": [("1", "  "), ("2", "")],
        "c": [("1", " only ")],
    }
    rows = corpus.corpus_texts(frame(spark, texts)).orderBy("corpus_key", "file_name").collect()
    assert "".join(r.text for r in rows if r.corpus_key == "a") == joined(texts["a"])
    assert [r.text for r in rows if r.corpus_key == "c"] == ["only"]
    assert not [r for r in rows if r.corpus_key == "b"]


def test_lines(spark):
    texts = {"a": [("1", "x\r\ny\n"), ("2", "z\x0bw ")]}
    rows = corpus.corpus_lines(frame(spark, texts)).orderBy("file_name", "line_no").collect()
    assert [r.text for r in rows] == joined(texts["a"]).splitlines()


@pytest.fixture(scope="module")
def corpora():
    pick = random.Random(5)
    sizes = {"hot": 250, "b": 1, "c": 5, "d": 40, "e": 2, "f": 60, "g": 3}

    def text():
        mark = pick.choice(["\n", "\r\n", "\n\n", " ", "\x85", " "])
        lengths = [pick.choice([0, 0, 1, 3, 7, 12, 25, 40]) for _ in range(pick.randint(0, 12))]
        body = mark.join("é" * n for n in lengths)
        return pick.choice([body, body, body, f" \n{body}\n \t", " "])

    return {k: [(f"{i:05d}", text()) for i in range(n)] for k, n in sizes.items()}


@pytest.mark.parametrize("limit, partitions", [(1, 5), (8, 16), (30, 1), (200, 7), (5000, 16)])
def test_blocks_of_corpora_that_cross_partitions(spark, corpora, limit, partitions):
    expected = {k: restated(joined(t), limit) for k, t in corpora.items() if joined(t)}
    assert found(corpus.blocks(frame(spark, corpora), limit, partitions=partitions)) == expected


def test_files_of_one_name_stand_once_each(spark):
    texts = [("k", "f", "one"), ("k", "f", "two"), ("k", "g", "last"), ("k", "f", "two"), ("j", "f", "one")]
    table = spark.createDataFrame(texts, "corpus_key string, file_name string, text string").repartition(3)
    blocks = {(r.corpus_key, r.text) for r in corpus.blocks(table, 100, partitions=3).collect()}
    assert blocks in ({("k", a), ("j", "one")} for a in ("one\n\ntwo\n\nlast".replace("\n\n", "\n\n"), "two\n\none\n\nlast"))
    lines = corpus.corpus_lines(table).where("corpus_key = 'k'").collect()
    assert sorted(r.text for r in lines) == ["", "", "last", "one", "two"]


def test_texts_are_scanned_twice_and_never_by_corpus(spark, corpora, tmp_path):
    path = str(tmp_path / "texts")
    frame(spark, corpora).write.parquet(path)
    table = spark.read.parquet(path)
    plan = corpus.blocks(table, 30, partitions=4)._jdf.queryExecution().executedPlan().toString()
    # The narrow table has been written by now: one of two scans is left.
    assert plan.count(path) == 1
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(corpus_key" in line]
    assert all("high" in line or "block_no" in line for line in exchanges)


def test_cleaning_first(spark):
    texts = {"k": [("1", "0:15 oi\n[risos] tchau"), ("2", " x\n\ny ")]}
    assert found(corpus.blocks(frame(spark, texts), 9, clean_first=True)) == {
        "k": ["oi tchau\n", "x y"]
    }


def test_one_summary_row_per_partition(spark, corpora):
    files = corpus.file_lines(frame(spark, corpora))
    kept = corpus._within(files, corpus._ends(files.where("n_lines > 0")))
    lengths = (
        kept.select(*corpus.KEYS, corpus._line_lengths().alias("line_lengths"))
        .repartitionByRange(9, *corpus.KEYS)
        .sortWithinPartitions(*corpus.KEYS)
        .select(F.spark_partition_id().alias("part"), "*")
    )
    rows = lengths.mapInPandas(corpus._summarise(30), corpus._SUMMARY).collect()
    assert len(rows) <= 9
    assert max(len(r.low) for r in rows) <= 31
