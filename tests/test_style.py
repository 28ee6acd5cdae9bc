"""Prompts, responses, style books, contexts, scoring and editing."""

import json
import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from newsloom.functions import prompts, style
from newsloom.operators import fusion, lexical, responses

AS_OF = datetime(2025, 8, 25, 12, 0, 0, 5, tzinfo=timezone.utc)


def test_prompt_marks(one):
    template = "{{a}}|{{b|x y}}|{{c}}|${a}|$a|${z}|$$|{{n|1}}|{ {a} }"
    filled = prompts.fill(template, {"a": F.col("v"), "n": 7})
    assert one(["T", "{{a}} ${a} }}"], filled) == [
        "T|x y||T|T|${z}|$|7|{ {a} }",
        "{{a}} ${a} }}|x y||{{a}} ${a} }}|{{a}} ${a} }}|${z}|$|7|{ {a} }",
    ]


def test_default_template_names_every_field(spark):
    blocks = spark.createDataFrame([("k", 1, "fala")], "corpus_key string, block_no int, text string")
    prompt = responses.prompts(blocks).first().prompt
    assert prompt.endswith("Trecho:\nfala\n") and "pt-BR" in prompt and "25 itens" in prompt
    for name in [*responses.SCALARS, *responses.EMPHASIS, *fusion.LIST_KEYS]:
        assert name in prompt
    assert not re.search(r"\{\{|\}\}", prompt)


RESPONSES = [
    '{"tom": "seco"}',
    ' ```json\n{"tom": "seco"}\n``` ',
    '```\n{"tom": "seco"}\n```',
    '{"tom": ' + "x" * 1200,
    '["tom"]',
    '"tom"',
    None,
    "",
    '{"tom": 3, "extra": 1, "bordoes": [{"texto": "a"}]}',
]


def test_responses(spark):
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(RESPONSES)], "i int, response string")
    found = responses.parsed(rows).orderBy("i").collect()
    assert [r.analysis.tom if r.analysis else None for r in found] == [
        "seco", "seco", "seco", None, None, None, None, None, "3"
    ]
    kinds = [r.error.kind if r.error else None for r in found]
    assert kinds == [
        None, None, None, "_erro_parse_json", "_erro_formato", "_erro_formato",
        "_erro_chamada_ia", "_erro_parse_json", None
    ]
    assert found[3].error.sample == RESPONSES[3][:1000]
    assert found[8].analysis.bordoes[0].texto == "a"


def test_every_block_has_an_analysis_or_an_error(spark):
    blocks = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b")], "corpus_key string, block_no int, text string")
    answers = spark.createDataFrame([("k", 2, "{}"), ("z", 1, "{}")], "corpus_key string, block_no int, response string")
    found = {r.block_no: r for r in responses.analyses(blocks, answers).collect()}
    assert set(found) == {1, 2}
    assert found[1].error.kind == "_erro_chamada_ia" and found[2].analysis is not None


def analysis(**fields):
    return json.dumps(fields, ensure_ascii=False)


@pytest.fixture
def analysed(spark):
    rows = [
        ("k", 1, analysis(
            tom="irônico", humor="ácido", ritmo="rápido", ritmo_comico="misto",
            estruturas_piada=[{"formato": "setup", "exemplo": "E1", "marcadores_lexicais": ["a", "b"]},
                              {"formato": "setup", "exemplo": "E2", "marcadores_lexicais": []}],
            gatilhos_comicos=[{"tipo": "absurdo", "intensidade": "alta", "exemplo": "g"}],
            marcadores_discurso=[{"texto": "cara", "frequencia_estimada": "alta"}, {"texto": "tipo"}],
            temas_recorrentes=[{"tema": "política"}, {"tema": ""}, {"tema": None}],
            pontuacoes_enfase={"caixa_alta": "alta", "pausas_elongadas": "media"},
            exemplos_representativos=["um", "dois"], confianca_global=0.85)),
        ("k", 2, analysis(
            tom="crítico", humor="sarcástico", ritmo="lento", ritmo_comico="misto",
            estruturas_piada=[{"formato": "Setup ", "exemplo": "e1", "marcadores_lexicais": ["c"]}],
            moldes_frasais=[{"molde": "m", "uso": "u"}],
            marcadores_discurso=[{"texto": " TIPO"}, {"texto": "tipo"}, {"texto": "só que"}],
            vicios_expressao=[{"texto": "x", "exemplo": "y"}],
            pontuacoes_enfase={"caixa_alta": "baixa", "pausas_elongadas": "media"},
            exemplos_representativos=["Um"], confianca_global=0.8)),
        ("k", 3, "broken"),
        ("z", 1, "broken"),
        ("w", 1, "{}"),
    ]
    frame = spark.createDataFrame(rows, "corpus_key string, block_no int, response string")
    return responses.parsed(frame)


def test_style_book(analysed):
    rows = {r.corpus_key: r for r in fusion.style_books(analysed, AS_OF).collect()}
    # A corpus whose blocks all failed has a record of that, and no book.
    assert set(rows) == {"k", "w", "z"} and rows["z"].book is None and rows["z"].error._erro_fusao
    assert rows["k"].error is None
    books = {key: row.book for key, row in rows.items()}
    book = books["k"]
    assert (book.tom, book.humor, book.ritmo, book.ritmo_comico) == ("irônico", "ácido", "rápido", "misto")
    assert book.pontuacoes_enfase.asDict() == {"caixa_alta": "alta", "pausas_elongadas": "media"}
    assert book.confianca_global == pytest.approx(0.825)
    assert [(e.formato, e.exemplo, e.marcadores_lexicais, e.peso) for e in book.estruturas_piada] == [
        ("setup", "E1", ["a", "b"], 1.0), ("setup", "E2", [], 0.5)
    ]
    assert [(m.texto, m.peso) for m in book.marcadores_discurso] == [
        ("tipo", 1.0), ("cara", 0.5), ("só que", 0.5)
    ]
    assert [t.tema for t in book.temas_recorrentes] == ["política"]
    assert book.exemplos_representativos == ["um", "dois"]
    assert book.moldes_frasais[0].uso == "u" and book.vicios_expressao[0].exemplo == "y"
    assert "tom: irônico / crítico" in book.observacoes and "ritmo_comico" not in book.observacoes
    assert (book.versao, book["_fonte"]) == ("2.0-blocos", "fusão_de_blocos")
    assert book.gerado_em == "2025-08-25T12:00:00.000005"
    assert books["w"].bordoes == [] and books["w"].tom is None


def test_list_size(spark):
    said = [{"texto": f"w{i:02d}"} for i in range(40)]
    rows = [("k", 1, analysis(bordoes=said)), ("k", 2, analysis(bordoes=said[30:]))]
    frame = responses.parsed(spark.createDataFrame(rows, "corpus_key string, block_no int, response string"))
    short = fusion.style_books(frame, AS_OF, max_items=3).first().book
    assert [b.texto for b in short.bordoes] == [f"w{i:02d}" for i in [*range(30, 40), *range(5)]]
    assert len(fusion.style_books(frame, AS_OF).first().book.bordoes) == 25


def ranked_by_hand(rows):
    """``(corpus, list, key, recurrence, place, text)`` of catchphrases, without the cut to a list's size."""
    found = {}
    for corpus, block, document in rows:
        first = {}
        for pos, item in enumerate((json.loads(document) if document else {}).get("bordoes") or []):
            key = (item.get("texto") or "").strip(" ").lower()
            if key:
                first.setdefault(key, pos)
        for key, pos in first.items():
            found.setdefault((corpus, key), []).append((block is not None, block or 0, pos))
    out = []
    for corpus in {c for c, _ in found if c is not None}:
        order = sorted((-len(said), min(said), key) for (c, key), said in found.items() if c == corpus)
        for place, (times, (known, block, pos), key) in enumerate(order, 1):
            for c, b, document in rows:
                if known and (c, b) == (corpus, block):
                    items = (json.loads(document) if document else {}).get("bordoes") or []
                    text = items[pos].get("texto") if pos < len(items) else None
                    out.append((corpus, "bordoes", key, -times, place, text))
    return out


ODD_ANALYSES = [
    ("a", 2, '{"bordoes":[{"texto":" N\\u00e9 "},{"texto":"cara"},{"texto":"n\\u00e9"},{"texto":""},{"texto":null}]}'),
    ("a", 1, '{"bordoes":[{"texto":"Cara"},{"texto":"sabe"},{"texto":"cara "},{"texto":"\\t"}]}'),
    ("a", 1, '{"bordoes":[{"texto":"Cara"},{"texto":"sabe"},{"texto":"cara "},{"texto":"\\t"}]}'),
    ("a", 3, '{"bordoes":[]}'),
    ("a", 4, '{"tom":"seco"}'),
    ("a", None, '{"bordoes":[{"texto":"N\\u00c9"},{"texto":"sem bloco"}]}'),
    ("a", 5, None),
    ("b", 7, '{"bordoes":[{"texto":"x"},{"texto":"y"}]}'),
    ("b", 7, '{"bordoes":[{"texto":"y"}]}'),
    ("c", 1, None),
    (None, 1, '{"bordoes":[{"texto":"ningu\\u00e9m"}]}'),
]


@pytest.fixture
def odd_analyses(spark, tmp_path):
    rows = spark.createDataFrame(ODD_ANALYSES, "corpus_key string, block_no bigint, json string")
    path = str(tmp_path / "analyses")
    analysis = F.from_json("json", responses.ANALYSIS_TYPE).alias("analysis")
    rows.select("corpus_key", "block_no", analysis).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def test_items_of_odd_analyses(odd_analyses):
    ranked = fusion.ranked_items(odd_analyses).collect()
    found = [(r.corpus_key, r.list, r.key, r.recurrence, r.place, r.item.texto if r.item else None) for r in ranked]
    order = lambda rows: sorted(rows, key=str)
    assert order(found) == order(ranked_by_hand(ODD_ANALYSES))


def test_ranking_puts_no_item_together_and_moves_no_analysis(odd_analyses):
    keys = fusion.item_keys(odd_analyses)._jdf.queryExecution().optimizedPlan().toString()
    assert "marcadores_lexicais" not in keys
    ranked = fusion.ranked_items(odd_analyses)._jdf.queryExecution().executedPlan().toString()
    # With few winners the analyses stay where they lie; items are put together once.
    assert "hashpartitioning" not in ranked and ranked.count("BroadcastHashJoin") == 1
    assert "size(transform" not in ranked


def test_scalars_read_no_lists(odd_analyses):
    fused = fusion.fused_scalars(odd_analyses)
    scans = fused._jdf.queryExecution().sparkPlan().collectLeaves()
    for i in range(scans.size()):
        assert "bordoes" not in scans.apply(i).requiredSchema().simpleString()
    found = {r.corpus_key: (r.partials, r.blocks, r.tom) for r in fused.collect()}
    assert found == {"a": (6, 7, "seco"), "b": (2, 2, None), "c": (0, 1, None), None: (1, 1, None)}


def test_mode_ties_go_to_the_first_block(spark):
    rows = [("k", n, analysis(tom=t)) for n, t in enumerate(["b", "a", "a", "b", "c"])]
    frame = responses.parsed(spark.createDataFrame(rows, "corpus_key string, block_no int, response string"))
    found = fusion.fused_scalars(frame).first()
    assert (found.tom, found.observacoes, found.partials) == ("b", "tom: b / a", 5)


def test_stamp_keeps_what_is_there(spark):
    book = F.from_json(F.lit('{"versao": "1", "gerado_em": "old"}'), responses.BOOK_TYPE)
    found = fusion.stamped(spark.range(1).select(book.alias("book")), AS_OF).first().book
    assert (found.versao, found["_fonte"]) == ("1", "fusão_de_blocos")
    assert found.gerado_em.startswith("2025-08-25T")


def test_context(spark):
    text = json.dumps({
        "tom": "t", "moldes_frasais": [{"molde": "m"}, {"molde": ""}, {"uso": "u"}],
        "bordoes": None, "marcadores_discurso": [{"texto": "x"}],
        "pontuacoes_enfase": {"pausas_elongadas": "alta"},
    })
    rows = spark.createDataFrame([(text,), ("{}",), (None,)], "j string")
    context = style.style_context(F.from_json("j", responses.BOOK_TYPE))
    full, empty, none = [r.c for r in rows.select(context.alias("c")).collect()]
    assert full.moldes_de_piada == ["m"] and full.marcadores == ["x"] and full.bordoes == []
    assert (full.tom, full.pausas) == ("t", "alta")
    assert empty.pausas is None and empty.interjeicoes == []
    assert none.tom is None and none.estruturas_piada == []


def score(text, phrases, avoided, questions, shouts):
    total = int(any(p in text for p in phrases))
    for mark, least in (("?", questions), ("!", shouts)):
        total += text.count(mark) / max(1, text.count(".")) >= least
    return total - sum(w in text for w in avoided)


def test_score(one):
    texts = ["cara? sim! ok.", "Cara. a. b! c?", "", "ruim ruim feio. !", "????..!", "não tem"]
    phrases, avoided = ["cara", "né"], ["ruim", "feio"]
    column = style.style_score(
        F.col("v"), F.array(*map(F.lit, phrases)), F.array(*map(F.lit, avoided)), F.lit(1.0), F.lit(0.5)
    )
    assert one(texts, column) == [score(t, phrases, avoided, 1.0, 0.5) for t in texts]


def test_remove(one):
    phrases = ["Em resumo", "", "(a+b)", "ção", r"\E.x"]
    texts = ["em RESUMO, emem resumo resumo", "(A+B) aab", "AÇÃO ação", r"y\E.x", "nada"]

    def restated(text):
        for phrase in phrases:
            text = re.sub(re.escape(phrase), "", text, flags=re.I)
        return text

    assert one(texts, style.remove_phrases(F.col("v"), phrases)) == [restated(t) for t in texts]


def test_insert(one):
    texts = ["A. B! C?", "só uma", "A.  \nB", ""]
    assert one(texts, style.insert_phrases(F.col("v"), ["x", "y"])) == [
        "A. x B! y C?", "só uma x", "A. x B y", " x"
    ]
    assert one(["A. B. C."], style.insert_phrases(F.col("v"), ["x"])) == ["A. x B. x C."]
    literal = style.insert_phrases(F.col("v"), ["x", "y"], literal_split=True)
    assert one(texts, literal) == ["A. B! C? x", "só uma x", "A.  \nB x", " x"]
    assert one(["Em resumo: A. B."], style.punch_up(F.col("v"), ["em resumo: "], ["x"])) == ["A. x B. x"]
    with pytest.raises(ValueError):
        style.insert_phrases(F.col("v"), [])


def test_outline(one):
    assert one(["T%s"], style.outline(F.col("v"))) == [
        r"Introdução indignada sobre: T%s\nResumo do conteúdo\nOpinião forte com final ácido"
    ]


def test_signals(spark):
    text = "CARA, cara... política política! Aí né AÍ nãooo"
    blocks = spark.createDataFrame([("k", 1, text), ("k", 2, "")], "corpus_key string, block_no int, text string")
    found = {r.block_no: r.analysis for r in lexical.lexical_analyses(blocks).collect()}
    one = found[1]
    assert [m.texto for m in one.marcadores_discurso] == ["aí", "cara", "né"]
    assert one.marcadores_discurso[0].frequencia_estimada == "alta"
    assert [t.tema for t in one.temas_recorrentes] == ["política"]
    assert one.pontuacoes_enfase.asDict() == {"caixa_alta": "alta", "pausas_elongadas": "alta"}
    assert found[2].marcadores_discurso == [] and found[2].pontuacoes_enfase.caixa_alta == "baixa"
    books = fusion.style_books(lexical.lexical_analyses(blocks), AS_OF).first().book
    assert style_texts(books.marcadores_discurso) == ["aí", "cara", "né"]


def style_texts(items):
    return [item.texto for item in items]


def test_recurrent_phrases(spark):
    rows = [("k", "conta outra vez agora"), ("k", "então Conta outra vez"), ("k", "conta outra"), ("k", ""),
            ("j", "conta outra vez")]
    texts = spark.createDataFrame(rows, "corpus_key string, text string")
    found = lexical.recurrent_phrases(texts, 3, 2).collect()
    assert [(r.corpus_key, r.phrase, r.texts) for r in found] == [("k", "conta outra vez", 2)]
    pairs = lexical.recurrent_phrases(texts, 2, 2).collect()
    assert [(r.phrase, r.texts, r.place) for r in pairs] == [("conta outra", 3, 1), ("outra vez", 2, 2)]


def test_recurrent_phrases_fold_in_order_of_texts(spark):
    texts = spark.createDataFrame([("c", f"a b {k}") for k in range(9)] + [("c", None), ("c", "a")], "corpus_key string, text string")
    found = lexical.recurrent_phrases(texts, 2, 2)
    assert "rangepartitioning(corpus_key" in found._jdf.queryExecution().executedPlan().toString()
    assert [(r.phrase, r.texts) for r in found.collect()] == [("a b", 9)]
