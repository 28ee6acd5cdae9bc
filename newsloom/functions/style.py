"""Scoring and editing a text with a style, and the style context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed

BLANK_RUN = r"(?U)[\s\x1c-\x1f]+"


def occurrences(text: Column, mark: str) -> Column:
    """How often a one-character mark occurs."""
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def style_score(
    text: Column,
    catchphrases: Column,
    avoid_words: Column,
    question_density: Column,
    exclamation_density: Column,
) -> Column:
    """Points for a catchphrase and for enough ``?`` and ``!`` per full stop, less one
    per avoided word; all tests are case-sensitive substring tests."""
    stops = F.greatest(F.lit(1), occurrences(text, "."))
    has_phrase = F.exists(catchphrases, lambda p: F.contains(text, p))
    avoided = F.size(F.filter(avoid_words, lambda w: F.contains(text, w)))
    return (
        has_phrase.cast("int")
        + (occurrences(text, "?") / stops >= question_density).cast("int")
        + (occurrences(text, "!") / stops >= exclamation_density).cast("int")
        - avoided
    )


def quoted(phrase: str) -> str:
    """A phrase as a literal, case-insensitive Java pattern."""
    return r"(?iu)\Q" + phrase.replace(r"\E", r"\E\\E\Q") + r"\E"


def remove_phrases(text: Column, phrases: Sequence[str]) -> Column:
    """Delete the phrases one after the other, in list order, any case."""
    for phrase in phrases:
        if phrase:
            text = F.regexp_replace(text, quoted(phrase), "")
    return text


def insert_phrases(
    text: Column,
    phrases: Sequence[str],
    most: int = fixed.PHRASES_INSERTED,
    literal_split: bool = False,
) -> Column:
    """Append a phrase to each of the first ``most`` sentences.

    ``literal_split`` cuts only at a backslash followed by ``s``s, which never
    happens in prose: the text then counts as one sentence.
    """
    if not phrases:
        raise ValueError("no phrase to insert")
    blank = r"\\s+" if literal_split else BLANK_RUN
    sentences = F.split(text, r"(?<=[.!?])" + blank)
    choices = F.array(*[F.lit(p) for p in phrases])

    def extended(sentence: Column, i: Column) -> Column:
        phrase = F.get(choices, (i % len(phrases)).cast("int"))
        return F.when(i < most, F.concat_ws(" ", sentence, phrase)).otherwise(sentence)

    return F.array_join(F.transform(sentences, extended), " ")


def punch_up(
    text: Column, negatives: Sequence[str], phrases: Sequence[str], literal_split: bool = False
) -> Column:
    return insert_phrases(
        remove_phrases(text, negatives), phrases, literal_split=literal_split
    )


def outline(title: Column) -> Column:
    return F.concat(
        F.lit(fixed.OUTLINE.split("%s")[0]), title, F.lit(fixed.OUTLINE.split("%s")[1])
    )


def style_context(book: Column) -> Column:
    """The part of a style book that goes into prompts."""

    def texts(items: str, field: str) -> Column:
        kept = F.filter(book[items], lambda item: F.length(item[field]) > 0)
        return F.coalesce(
            F.transform(kept, lambda item: item[field]), F.array().cast("array<string>")
        )

    return F.struct(
        book["tom"].alias("tom"),
        book["humor"].alias("humor"),
        book["ritmo"].alias("ritmo"),
        book["ritmo_comico"].alias("ritmo_comico"),
        texts("moldes_frasais", "molde").alias("moldes_de_piada"),
        texts("estruturas_piada", "formato").alias("estruturas_piada"),
        texts("gatilhos_comicos", "tipo").alias("gatilhos_comicos"),
        texts("marcadores_discurso", "texto").alias("marcadores"),
        texts("bordoes", "texto").alias("bordoes"),
        texts("interjeicoes", "texto").alias("interjeicoes"),
        book["pontuacoes_enfase"]["pausas_elongadas"].alias("pausas"),
    )
