"""Cleaning and line splitting against a plain restatement in Python."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.functions import cleaning

MARKS = "|".join(["aplausos", "música", "risos", "music", "applause", "laughs", "inaudível"])


def restated(text):
    text = re.sub(r"\b\d{1,2}:\d{2}(?::\d{2})?\b", "", text)
    text = re.sub(rf"\[(?:{MARKS}).*?\]", "", text, flags=re.I)
    return re.sub(r"\s+", " ", text).strip()


CASES = [
    "0:15 oi 1:02:03 tchau",
    "[MÚSICA alta] a [ __ ] [risos]",
    "a [música\nquebrada] b",
    "٠:١٥ x ١٢:٣٤",
    "a\u2028b\xa0c\x1cd\x85e",
    "x1:23 12:345 1:02:033 123:45 _1:23 1:23_ é1:23",
    "[Aplausos [risos] x]",
    "[inaudÍvel] [LAUGHS\r] [applause\u2028 y]",
    " \t\n ",
    "",
]


def test_cases(one):
    assert one(CASES, cleaning.clean_text(F.col("v"))) == [restated(t) for t in CASES]


def test_spoken_text_keeps_its_words(one):
    raw = "Ele abandonou a esposa e\nagora vende doce.\xa0Ai\n[ __ ] será?\n"
    assert one([raw], cleaning.clean_text(F.col("v"))) == [
        "Ele abandonou a esposa e agora vende doce. Ai [ __ ] será?"
    ]


PIECES = ["0:15", "1:02:03", "[risos]", "[Música", "]", " ", "\n", "\r\n", "\x0b", "\x1c", "\x85",
          "\u2028", "\xa0", "a", "É", "9", ":", "_", "[ __ ]", "\u3000"]
RUNS = settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
TEXTS = st.lists(
    st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=40, max_size=40
)


@RUNS
@given(TEXTS)
def test_any_text(one, texts):
    assert one(texts, cleaning.clean_text(F.col("v"))) == [restated(t) for t in texts]


@RUNS
@given(TEXTS)
def test_any_lines(one, texts):
    assert one(texts, cleaning.lines(F.col("v"))) == [t.splitlines() for t in texts]


@RUNS
@given(TEXTS)
def test_any_strip(one, texts):
    assert one(texts, cleaning.strip(F.col("v"))) == [t.strip() for t in texts]
