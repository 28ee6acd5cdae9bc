"""Style book of a corpus from the analyses of its blocks.

All lists of all analyses become one long table, so one aggregation and one
ranking serve the nine lists of every corpus. A list in the result holds at
most ``max_items`` items, which bounds every group that is gathered.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom import fixed_values as fixed
from newsloom.operators.responses import BOOK_TYPE, EMPHASIS, NOT_MERGED, SCALARS
from newsloom.session import stored

# ---- Fixed values: what makes two items of a list the same ----------------
LIST_KEYS = {
    "estruturas_piada": ["formato", "exemplo"],
    "gatilhos_comicos": ["tipo", "exemplo"],
    "moldes_frasais": ["molde"],
    "vicios_expressao": ["texto"],
    "marcadores_discurso": ["texto"],
    "bordoes": ["texto"],
    "interjeicoes": ["texto"],
    "temas_recorrentes": ["tema"],
    "exemplos_representativos": [],
}
# The parts an item may consist of, over all lists.
ITEM_PARTS = ["formato", "tipo", "intensidade", "molde", "uso", "texto", "tema", "exemplo"]
LIST_PARTS = {
    "estruturas_piada": ["formato", "exemplo", "marcadores_lexicais"],
    "gatilhos_comicos": ["tipo", "intensidade", "exemplo"],
    "moldes_frasais": ["molde", "uso"],
    "vicios_expressao": ["texto", "exemplo"],
    "marcadores_discurso": ["texto"],
    "bordoes": ["texto", "exemplo"],
    "interjeicoes": ["texto"],
    "temas_recorrentes": ["tema"],
    "exemplos_representativos": [],
}
KEY_MARK = "\x1f"  # between the parts of a key
UNWEIGHTED = {"vicios_expressao", "exemplos_representativos"}


def _key(name: str) -> str:
    """What makes an item ``x`` of a list the same as another (an SQL expression)."""
    same = [f"lower(trim(coalesce({k}, '')))" for k in [f"x.{k}" for k in LIST_KEYS[name]] or ["x"]]
    return same[0] if len(same) == 1 else f"concat_ws('{KEY_MARK}', {', '.join(same)})"


def _items(name: str) -> str:
    """One list of an analysis as items of the common shape (an SQL expression)."""
    parts = LIST_PARTS[name]
    said = {p: f"x.{p}" if p in parts else "cast(null AS string)" for p in ITEM_PARTS}
    if not parts:
        said["exemplo"] = "x"
    fields = ", ".join(f"'{p}', {value}" for p, value in said.items())
    marks = "x.marcadores_lexicais" if "marcadores_lexicais" in parts else "null"
    return (
        f"transform(analysis.{name}, (x, i) -> named_struct('list', '{name}', 'pos', i, "
        f"'key', {_key(name)}, 'item', named_struct({fields}, "
        f"'marcadores_lexicais', cast({marks} AS array<string>))))"
    )


def _every_item() -> str:
    return f"concat({', '.join(f'coalesce({_items(n)}, array())' for n in LIST_KEYS)})"


def _said(key: str) -> str:
    return f"replace({key}, '{KEY_MARK}', '') <> ''"


def exploded_items(analyses: DataFrame) -> DataFrame:
    """``(corpus_key, block_no, list, pos, key, item)`` of all lists; empty keys go.

    There is no filter on ``analysis``: it would be pushed below its parsing
    and parse twice. A null one has no items.
    """
    rows = analyses.select("corpus_key", "block_no", F.expr(f"inline({_every_item()})"))
    return rows.filter(_said("key"))


def _first_keys(name: str) -> str:
    """Each key of a list once, with the position where it is said first (an SQL expression).

    Sorted by key and position, an item is new when its key differs from that of the one before.
    """
    keys = f"sort_array(transform(analysis.{name}, (x, i) -> named_struct('key', {_key(name)}, 'pos', i)))"
    firsts = "filter(said, (x, i) -> i = 0 OR get(said, i - 1).key <> x.key)"
    return f"get(transform(array({keys}), said -> {firsts}), 0)"


def item_keys(analyses: DataFrame) -> DataFrame:
    """``(corpus_key, block_no, list, key, pos)``: each key of a block once, where it is said first.

    Lists are sorted one by one, keys and positions only; no item is put together.
    """
    lists = ", ".join(f"named_struct('list', '{n}', 'firsts', {_first_keys(n)})" for n in LIST_KEYS)
    rows = analyses.select("corpus_key", "block_no", F.expr(f"inline(array({lists}))"))
    return rows.select("corpus_key", "block_no", "list", F.inline("firsts")).filter(_said("key"))


def ranked_keys(keys: DataFrame, max_items: int = fixed.LIST_ITEMS) -> DataFrame:
    """Keys of the items that stay, with ``recurrence``, ``first`` (block and position), ``place``.

    Recurrence is the number of blocks, of which each has one row in ``analyses``; the first form,
    by block and position, stands for the item and breaks ties. Two exchanges, of keys alone.
    """
    merged = keys.groupBy("corpus_key", "list", "key").agg(
        F.count("*").alias("recurrence"), F.min(F.struct("block_no", "pos")).alias("first")
    )
    window = Window.partitionBy("corpus_key", "list").orderBy(
        F.col("recurrence").desc(), "first", "key"
    )
    cap = max(max_items, fixed.LIST_ITEMS_FLOOR)
    return merged.withColumn("place", F.row_number().over(window)).filter(F.col("place") <= cap)


def ranked_items(analyses: DataFrame, max_items: int = fixed.LIST_ITEMS) -> DataFrame:
    """Items that are the same once, the most recurrent first, cut to the list size.

    ``(corpus_key, list, key, recurrence, first, place, item)``. The ranking is done on keys;
    items are fetched for the winners only, from the blocks that said them first.
    ``analyses`` is read twice. The winners are stored: their size is then known, and while they are
    few analyses meet them where they lie.
    """
    winners = ranked_keys(item_keys(analyses), max_items)
    first = winners.select(
        "corpus_key", F.col("first.block_no").alias("block_no"), F.col("first.pos").alias("pos"),
        "list", "key", "recurrence", "first", "place",
    )
    wanted = first.groupBy("corpus_key", "block_no").agg(
        F.collect_list(F.struct("list", "pos", "key", "recurrence", "first", "place")).alias("wanted")
    )
    wanted = stored(wanted, "wanted")
    # A block names its winners; each takes its item out of the list by its position.
    item = "transform(wanted, w -> struct(w.list AS list, w.key AS key, w.recurrence AS recurrence, " + (
        "w.first AS first, w.place AS place, "
        "get(filter(items, x -> x.list = w.list AND x.pos = w.pos), 0).item AS item))"
    )
    met = analyses.join(wanted, ["corpus_key", "block_no"]).select(
        "corpus_key", F.expr(f"get(transform(array({_every_item()}), items -> {item}), 0)").alias("won")
    )
    # No block here is without a winner; a plain inline would have items put together once more to test that.
    return met.select("corpus_key", F.inline_outer("won"))


def scalar_views(analyses: DataFrame) -> DataFrame:
    """The two strongest values of every scalar: ``(corpus_key, field, place, value, blocks)``.

    Strongest is the most frequent, then the one said first.
    """
    said = [
        F.struct(F.lit(n).alias("field"), F.col("analysis")[n].alias("value")) for n in SCALARS
    ]
    said += [
        F.struct(F.lit(n).alias("field"), F.col("analysis.pontuacoes_enfase")[n].alias("value"))
        for n in EMPHASIS
    ]
    views = (
        analyses.select("corpus_key", "block_no", F.inline(F.array(*said)))
        .filter(F.col("value").isNotNull())
        .groupBy("corpus_key", "field", "value")
        .agg(F.count("*").alias("blocks"), F.min("block_no").alias("first"))
    )
    window = Window.partitionBy("corpus_key", "field").orderBy(
        F.col("blocks").desc(), "first", "value"
    )
    return (
        views.withColumn("place", F.row_number().over(window))
        .filter(F.col("place") <= 2)
        .drop("first")
    )


def fused_scalars(analyses: DataFrame) -> DataFrame:
    """One row per corpus: consensus of each scalar, notes on conflicts, mean confidence.

    A corpus none of whose blocks was analysed has ``partials`` 0 and no values.
    Where the values disagree, the two strongest are noted in ``observacoes``.
    """
    fields = SCALARS + EMPHASIS
    views = scalar_views(analyses)

    def view(name: str, place: int) -> Column:
        here = (F.col("field") == name) & (F.col("place") == place)
        return F.max(F.when(here, F.col("value")))

    wide = views.groupBy("corpus_key").agg(
        *[view(n, 1).alias(n) for n in fields], *[view(n, 2).alias(f"_{n}") for n in fields]
    )
    notes = F.concat_ws(
        "; ",
        *[
            F.when(F.col(f"_{n}").isNotNull(), F.concat(F.lit(f"{n}: "), n, F.lit(" / "), f"_{n}"))
            for n in fields
        ],
    )
    # Whether there is an analysis is told by any of its fields; counting the value would read all its lists.
    totals = analyses.groupBy("corpus_key").agg(
        F.count_if(F.col("analysis").isNotNull()).alias("partials"),
        F.count("*").alias("blocks"),
        F.avg("analysis.confianca_global").alias("confianca_global"),
    )
    return totals.join(wide, "corpus_key", "left").select(
        "corpus_key",
        "partials",
        "blocks",
        *fields,
        F.nullif(notes, F.lit("")).alias("observacoes"),
        "confianca_global",
    )


def _book_list(name: str) -> str:
    """One list of the book from the gathered items of a corpus (an SQL expression)."""
    parts = LIST_PARTS[name]
    said = [f"'{p}', x.item.{p}" for p in parts]
    if name not in UNWEIGHTED:
        said.append("'peso', x.recurrence / partials")
    entry = f"named_struct({', '.join(said)})" if parts else "x.item.exemplo"
    return f"transform(filter(items, x -> x.list = '{name}'), x -> {entry})"


FAILED_TYPE = "struct<_erro_fusao:boolean,_mensagem:string,versao:string,gerado_em:string,_fonte:string>"


def style_books(
    analyses: DataFrame, as_of: datetime, max_items: int = fixed.LIST_ITEMS
) -> DataFrame:
    """``(corpus_key, book, error)``: one style book per corpus, stamped.

    A corpus none of whose blocks was analysed keeps its row: ``book`` is null and ``error`` a
    stamped record of the failed merge. Reads ``analyses`` four times, twice without its lists; give a
    table that has been written.
    """
    made = _moment(as_of)
    row = F.struct("list", "place", "recurrence", "item")
    gathered = (
        ranked_items(analyses, max_items)
        .groupBy("corpus_key")
        .agg(F.array_sort(F.collect_list(row)).alias("items"))
    )
    whole = fused_scalars(analyses).join(gathered, "corpus_key", "left")
    stamps = {
        "versao": f"'{fixed.STYLE_VERSION}'",
        "gerado_em": f"'{made}'",
        "_fonte": f"'{fixed.STYLE_SOURCE}'",
    }
    fields = {
        **{n: n for n in SCALARS},
        **{n: f"coalesce({_book_list(n)}, array())" for n in LIST_KEYS},
        "pontuacoes_enfase": f"struct({', '.join(EMPHASIS)})",
        "observacoes": "observacoes",
        "confianca_global": "confianca_global",
        **stamps,
    }
    names = T.DataType.fromDDL(BOOK_TYPE).names
    book = F.expr(f"named_struct({', '.join(f'{n!r}, {fields[n]}' for n in names)})")
    error = F.struct(
        F.lit(True).alias(NOT_MERGED),
        F.concat(F.lit("none of "), F.col("blocks").cast("string"), F.lit(" blocks was analysed")).alias("_mensagem"),
        *[F.expr(value).alias(name) for name, value in stamps.items()],
    )
    return whole.select(
        "corpus_key",
        F.when(F.col("partials") > 0, book.cast(BOOK_TYPE)).alias("book"),
        F.when(F.col("partials") == 0, error.cast(FAILED_TYPE)).alias("error"),
    )


def book_document() -> Column:
    """A book, or the record of its failed merge, as JSON; null fields are kept."""
    keep = {"ignoreNullFields": "false"}
    return F.coalesce(F.to_json("book", keep), F.to_json("error", keep))


def _moment(as_of: datetime) -> str:
    if as_of.tzinfo is None:
        raise ValueError("as_of needs a time zone")
    return as_of.astimezone(timezone.utc).replace(tzinfo=None).isoformat()


def stamped(books: DataFrame, as_of: datetime) -> DataFrame:
    """Stamp books that came from elsewhere: version and origin only where absent."""
    made = _moment(as_of)
    book = F.col("book")
    book = book.withField("versao", F.coalesce(book["versao"], F.lit(fixed.STYLE_VERSION)))
    book = book.withField("_fonte", F.coalesce(F.col("book._fonte"), F.lit(fixed.STYLE_SOURCE)))
    return books.withColumn("book", book.withField("gerado_em", F.lit(made)))
