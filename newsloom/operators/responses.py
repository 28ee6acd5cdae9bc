"""Prompts out, responses in, and the schema of an analysis."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed
from newsloom.functions.cleaning import strip
from newsloom.functions.prompts import ANALYSIS_TEMPLATE, fill

# ---- Fixed values: fields of an analysis and of a style book -------------
SCALARS = ["tom", "humor", "ritmo", "ritmo_comico"]
EMPHASIS = ["caixa_alta", "pausas_elongadas"]
ANALYSIS_TYPE = (
    "struct<tom:string,humor:string,ritmo:string,ritmo_comico:string,"
    "estruturas_piada:array<struct<formato:string,exemplo:string,"
    "marcadores_lexicais:array<string>>>,"
    "gatilhos_comicos:array<struct<tipo:string,intensidade:string,exemplo:string>>,"
    "moldes_frasais:array<struct<molde:string,uso:string>>,"
    "vicios_expressao:array<struct<texto:string,exemplo:string>>,"
    "marcadores_discurso:array<struct<texto:string,frequencia_estimada:string>>,"
    "bordoes:array<struct<texto:string,exemplo:string>>,"
    "interjeicoes:array<struct<texto:string>>,"
    "temas_recorrentes:array<struct<tema:string>>,"
    "pontuacoes_enfase:struct<caixa_alta:string,pausas_elongadas:string>,"
    "exemplos_representativos:array<string>,"
    "confianca_global:double>"
)
BOOK_TYPE = (
    "struct<tom:string,humor:string,ritmo:string,ritmo_comico:string,"
    "estruturas_piada:array<struct<formato:string,exemplo:string,"
    "marcadores_lexicais:array<string>,peso:double>>,"
    "gatilhos_comicos:array<struct<tipo:string,intensidade:string,exemplo:string,peso:double>>,"
    "moldes_frasais:array<struct<molde:string,uso:string,peso:double>>,"
    "vicios_expressao:array<struct<texto:string,exemplo:string>>,"
    "marcadores_discurso:array<struct<texto:string,peso:double>>,"
    "bordoes:array<struct<texto:string,exemplo:string,peso:double>>,"
    "interjeicoes:array<struct<texto:string,peso:double>>,"
    "temas_recorrentes:array<struct<tema:string,peso:double>>,"
    "pontuacoes_enfase:struct<caixa_alta:string,pausas_elongadas:string>,"
    "exemplos_representativos:array<string>,"
    "observacoes:string,confianca_global:double,"
    "versao:string,gerado_em:string,_fonte:string>"
)

# ---- Fixed values: kinds of error -----------------------------------------
NO_RESPONSE = "_erro_chamada_ia"
NOT_JSON = "_erro_parse_json"
NOT_AN_OBJECT = "_erro_formato"
NOT_MERGED = "_erro_fusao"

# ---- Fixed values: the fence around a JSON answer -------------------------
FENCE = r"(?imdU)^```(?:json)?\s*|\s*```$"


def prompts(
    blocks: DataFrame,
    template: str = ANALYSIS_TEMPLATE,
    language: str = fixed.STYLE_LANGUAGE,
    max_items: int = fixed.LIST_ITEMS,
    values: Mapping[str, Column | str | int | float] | None = None,
) -> DataFrame:
    """``(corpus_key, block_no, prompt)``: the template filled with each block."""
    known = {"trecho": F.col("text"), "idioma": language, "max_itens": max_items}
    known.update(values or {})
    return blocks.select("corpus_key", "block_no", fill(template, known).alias("prompt"))


def strip_fences(payload: Column) -> Column:
    """The JSON inside a fenced block; other text only loses its outer blanks."""
    bare = strip(payload)
    return F.when(
        F.startswith(bare, F.lit("```")), F.regexp_replace(bare, FENCE, "")
    ).otherwise(bare)


def _error(kind: Column, message: Column, sample: Column) -> Column:
    return F.struct(kind.alias("kind"), message.alias("message"), sample.alias("sample"))


#: Python's JSON reader takes NaN and Infinity, and so does Spark's; single quotes neither.
STRICT = {"allowSingleQuotes": "false"}


def _is_one_value(text: Column) -> Column:
    """In a list with one more element a text that is JSON at all makes one element."""
    return F.size(F.from_json(F.concat(F.lit("["), text, F.lit(',"E"]')), "array<string>", STRICT)) == 2


def is_json(text: Column) -> Column:
    """One whole JSON value and nothing after it.

    The value stands once inside an object, where a field behind it is only reached
    when the value is complete, and once inside a list, where it has to be one element.
    """
    whole = F.from_json(F.concat(F.lit('{"v":'), text, F.lit(',"_end":1}')), "_end int", STRICT)
    return F.coalesce((whole["_end"] == 1) & _is_one_value(text), F.lit(False))


def parsed(responses: DataFrame, schema: str = ANALYSIS_TYPE) -> DataFrame:
    """Adds ``analysis`` and ``error`` to ``response``: exactly one of them is null.

    Errors: no response, text that is not JSON, JSON that is not an object or
    whose fields have other types than ``schema``; all but the first keep the
    start of the response. A text field takes any scalar as it is written; a number, a
    list and an object take nothing else. Of a repeated key the last value counts.
    """
    payload = F.col("response")
    body = strip_fences(payload)
    is_object = F.startswith(strip(body), F.lit("{"))
    nothing = F.lit(None).cast("string")
    # The body stands in an object with a field behind it: reached only if the body is whole.
    around = F.concat(F.lit('{"v":'), body, F.lit(',"_end":1}'))
    options = {**STRICT, "columnNameOfCorruptRecord": "_bad"}
    held = F.from_json(around, f"v {schema}, _end int, _bad string", options)
    is_good = (
        is_object
        & (F.col("_held._end") == 1)
        & F.col("_held._bad").isNull()
        & _is_one_value(body)
    )
    form = F.substring(body, 1, fixed.FORMAT_SAMPLE_CHARS)
    # What is wrong is looked into only where something is.
    error = (
        F.when(payload.isNull(), _error(F.lit(NO_RESPONSE), F.lit("no response"), nothing))
        .when(F.col("_good"), None)
        .when(
            ~is_json(body),
            _error(
                F.lit(NOT_JSON), nothing, F.substring(payload, 1, fixed.PARSE_SAMPLE_CHARS)
            ),
        )
        .when(~is_object, _error(F.lit(NOT_AN_OBJECT), nothing, form))
        .otherwise(_error(F.lit(NOT_AN_OBJECT), F.lit("a field has another type"), form))
    )
    return (
        responses.withColumn("_held", held)
        .withColumn("_good", F.coalesce(is_good, F.lit(False)))
        .withColumn("error", error)
        .withColumn("analysis", F.when(F.col("_good"), F.col("_held.v")))
        .drop("_held", "_good")
    )


def analyses(blocks: DataFrame, responses: DataFrame, schema: str = ANALYSIS_TYPE) -> DataFrame:
    """Every block with its analysis or error.

    Of several responses to a block a JSON object goes before anything else,
    then the greatest text.
    """
    keys = ["corpus_key", "block_no"]
    body = strip_fences(F.col("response"))
    usable = F.startswith(body, F.lit("{")) & is_json(body)
    single = responses.groupBy(*keys).agg(
        F.max(F.struct(usable.alias("usable"), "response"))["response"].alias("response")
    )
    answered = blocks.select(*keys).join(single, keys, "left")
    return parsed(answered, schema).drop("response")
