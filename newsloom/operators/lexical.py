"""Style signals that can be counted, in the shape of an analysis.

Merging, ranking and the context then run on it unchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import NGram
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed
from newsloom.operators import runs
from newsloom.operators.responses import ANALYSIS_TYPE
from newsloom.session import stored

WORD = r"(?U)\w+"
# Word lists and levels of our own; jobs may pass others.
MARKERS = ("aí", "bom", "cara", "então", "né", "porque", "sim", "só", "tipo")
INTERJECTIONS = ("ah", "eita", "nossa", "oh", "opa", "ué", "uau")
LEVELS = (0.01, 0.05)
TOPIC_CHARS = 6
# Characters by which texts are put in order before their runs are counted.
ORDER_CHARS = 40
BLOCK = ["corpus_key", "block_no"]
LONG_PAUSE = r"(?U)…|\.{3,}|(\p{L})\1{2,}"


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def level(share: Column, levels: tuple[float, float] = LEVELS) -> Column:
    return (
        F.when(share < levels[0], "baixa").when(share < levels[1], "media").otherwise("alta")
    )


def caps_share(text: Column) -> Column:
    """Words of two or more letters in capitals, among all words."""
    every = words(text)
    caps = F.filter(
        every, lambda w: (F.length(w) > 1) & (F.upper(w) == w) & (F.lower(w) != w)
    )
    return F.size(caps) / F.greatest(F.size(every), F.lit(1))


def pause_share(text: Column) -> Column:
    """Ellipses and drawn-out letters, per word."""
    return F.regexp_count(text, F.lit(LONG_PAUSE)) / F.greatest(F.size(words(text)), F.lit(1))


def _counted(blocks: DataFrame, markers, interjections, max_items: int) -> DataFrame:
    """``(corpus_key, block_no, kind, place, word, n)``: the words of each block by use.

    Counts are folded on the map side, where a block already is in one place.
    """
    word = F.col("word")
    uses = F.array_compact(
        F.array(
            F.when(word.isin(list(markers)), "marker"),
            F.when(word.isin(list(interjections)), "interjection"),
            F.when((F.length(word) >= TOPIC_CHARS) & (F.col("n") > 1), "topic"),
        )
    )
    counts = (
        blocks.select(*BLOCK, F.explode(words(F.lower(F.col("text")))).alias("word"))
        .groupBy(*BLOCK, "word")
        .agg(F.count("*").alias("n"))
        .select(*BLOCK, "word", "n", F.explode(uses).alias("kind"))
    )
    window = Window.partitionBy(*BLOCK, "kind").orderBy(F.col("n").desc(), "word")
    return counts.withColumn("place", F.row_number().over(window)).filter(
        F.col("place") <= max_items
    )


def _with_runs(rows: DataFrame, said: str, size: int, name: str) -> DataFrame:
    """The runs of ``size`` words of a row's list of words, in their order; words stand a blank apart."""
    return NGram(n=size, inputCol=said, outputCol=name).transform(rows)


def _said(texts: DataFrame) -> DataFrame:
    """``(corpus_key, said)``: the words of each text in lower case."""
    return texts.where(F.col("text").isNotNull()).select("corpus_key", words(F.lower(F.col("text"))).alias("said"))


def _spoken(texts: DataFrame) -> DataFrame:
    """``(corpus_key, said)``: the words of each text in lower case.

    Texts are put in order by corpus and text, so that texts of one corpus, and copies, are in one
    task, where counts of their runs fold before the shuffle. The start of a text will do for that; of many
    texts that begin alike some go to the next task.
    """
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.substring("text", 1, ORDER_CHARS), F.xxhash64("text"), F.monotonically_increasing_id()]
    ordered = texts.where(F.col("text").isNotNull()).select("corpus_key", "text", F.struct(*order).alias("place"))
    return _said(ordered.repartitionByRange(n, "corpus_key", "place"))


def catchphrases(
    texts: DataFrame,
    least_texts: int = 3,
    max_words: int = 6,
    most: int = fixed.LIST_ITEMS,
) -> DataFrame:
    """``(corpus_key, phrase, words, texts, place)``: runs of two to ``max_words`` words that recur
    in a corpus and are part of no longer one in the same texts.

    All lengths are counted in one pass and one shuffle: a text gives each run once, and counts are
    folded before the shuffle. Before that ``runs.frequent`` finds the words that runs of the first ``most``
    places can have, and only runs of these are counted: a run kept here has ``max_words - 1``
    pairs of words at most, so as many pairs for each place are enough. A longer run is in some of the texts
    of its parts; when the counts agree they are the same texts, and the part goes. Words are compared
    in lower case. The most frequent come first, longer ones before shorter.
    """
    spoken = _said(texts)
    kept = runs.frequent(spoken, least_texts, most * (max_words - 1))
    every = stored(
        runs.counted(spoken, range(2, max_words + 1), kept)
        .where(F.col("texts") >= least_texts)
        .select("corpus_key", F.col("run").alias("phrase"), F.size(F.split("run", " ")).alias("words"), "texts"),
        "recurrent",
    )
    said = F.split("phrase", " ")
    parts = F.array(
        F.array_join(F.slice(said, F.lit(1), F.col("words") - 1), " "), F.array_join(F.slice(said, F.lit(2), F.col("words") - 1), " ")
    )
    longer = (
        every.where("words > 2")
        .select("corpus_key", F.explode(F.array_distinct(parts)).alias("phrase"), "texts")
        .groupBy("corpus_key", "phrase")
        .agg(F.max("texts").alias("longer"))
    )
    whole = every.join(longer, ["corpus_key", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") < F.col("texts"))
    )
    window = Window.partitionBy("corpus_key").orderBy(F.col("texts").desc(), F.col("words").desc(), "phrase")
    return (
        whole.withColumn("place", F.row_number().over(window)).where(F.col("place") <= most).drop("longer")
    )


def _said_phrases(blocks: DataFrame, phrases: DataFrame) -> DataFrame:
    """``(corpus_key, block_no, phrases)``: those of its corpus that a block says, in their order."""
    listed = phrases.groupBy("corpus_key").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "phrase"))), lambda p: p["phrase"]).alias("every")
    )
    text = F.concat(F.lit(" "), F.array_join(words(F.lower(F.col("text"))), " "), F.lit(" "))
    with_text = blocks.join(listed, "corpus_key").select(*BLOCK, text.alias("_said"), "every")

    def spoken(row: Column) -> Column:
        return F.filter(
            row["every"], lambda p: F.contains(row["said"], F.concat(F.lit(" "), p, F.lit(" ")))
        )

    one = F.struct(F.col("_said").alias("said"), "every")
    return with_text.select(*BLOCK, F.get(F.transform(F.array(one), spoken), F.lit(0)).alias("phrases"))


def lexical_analyses(
    blocks: DataFrame,
    markers: Sequence[str] = MARKERS,
    interjections: Sequence[str] = INTERJECTIONS,
    max_items: int = fixed.LIST_ITEMS,
    phrases: DataFrame | None = None,
) -> DataFrame:
    """``(corpus_key, block_no, analysis)`` from counts alone, without any model.

    What cannot be counted is null or empty. A block gathers at most
    ``max_items`` words of each kind. ``phrases``, as ``catchphrases`` gives them (at most
    ``max_items`` a corpus), fill ``bordoes`` with those a block says.
    """
    if phrases is None:
        phrases = blocks.sparkSession.createDataFrame([], "corpus_key string, phrase string, place int")
    row = F.struct("kind", "place", "word", "n")
    gathered = (
        _counted(blocks, markers, interjections, max_items)
        .groupBy(*BLOCK)
        .agg(F.array_sort(F.collect_list(row)).alias("said"))
    )
    text = F.col("text")
    shares = blocks.select(
        *BLOCK,
        F.size(words(text)).alias("total"),
        level(caps_share(text)).alias("caps"),
        level(pause_share(text)).alias("pauses"),
    )

    def of_kind(kind: str, shape: Callable[[Column], Column]) -> Column:
        mine = F.filter(F.col("said"), lambda r: r["kind"] == kind)
        return F.coalesce(F.transform(mine, shape), F.array())

    nothing, empty = F.lit(None), F.array()
    analysis = F.struct(
        nothing.alias("tom"),
        nothing.alias("humor"),
        nothing.alias("ritmo"),
        nothing.alias("ritmo_comico"),
        empty.alias("estruturas_piada"),
        empty.alias("gatilhos_comicos"),
        empty.alias("moldes_frasais"),
        empty.alias("vicios_expressao"),
        of_kind(
            "marker",
            lambda r: F.struct(
                r["word"].alias("texto"),
                level(r["n"] / F.col("total")).alias("frequencia_estimada"),
            ),
        ).alias("marcadores_discurso"),
        F.coalesce(
            F.transform("phrases", lambda p: F.struct(p.alias("texto"), nothing.cast("string").alias("exemplo"))),
            empty,
        ).alias("bordoes"),
        of_kind("interjection", lambda r: F.struct(r["word"].alias("texto"))).alias(
            "interjeicoes"
        ),
        of_kind("topic", lambda r: F.struct(r["word"].alias("tema"))).alias(
            "temas_recorrentes"
        ),
        F.struct(F.col("caps").alias("caixa_alta"), F.col("pauses").alias("pausas_elongadas")),
        empty.alias("exemplos_representativos"),
        nothing.alias("confianca_global"),
    ).cast(ANALYSIS_TYPE)
    said_phrases = _said_phrases(blocks, phrases)
    every = shares.join(gathered, BLOCK, "left").join(said_phrases, BLOCK, "left")
    return every.select(*BLOCK, analysis.alias("analysis"))


def recurrent_phrases(
    texts: DataFrame, size: int = 3, least_texts: int = 2, most: int = fixed.LIST_ITEMS
) -> DataFrame:
    """Runs of ``size`` words found in several texts of a corpus, the most frequent first.

    A text sends each of its phrases once; counts are folded before both the
    shuffle by phrase and the one by corpus.
    """
    phrases = (
        _with_runs(_spoken(texts), "said", size, "_runs")
        .select("corpus_key", F.explode(F.array_distinct("_runs")).alias("phrase"))
        .groupBy("corpus_key", "phrase")
        .agg(F.count("*").alias("texts"))
        .filter(F.col("texts") >= least_texts)
    )
    window = Window.partitionBy("corpus_key").orderBy(F.col("texts").desc(), "phrase")
    return phrases.withColumn("place", F.row_number().over(window)).filter(
        F.col("place") <= most
    )
