"""Address parts against the standard library, and the language and place tests."""

from urllib.parse import parse_qs, urlparse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.functions import language, urls

ODD = [
    "https://www.globo.com/x", "https://G1.GLOBO.com/x", "https://x.pt/",
    "https://x.com.br:8080/", "https://x.com/?LANG=pt-PT", "https://x.com/?hl=pt_BR",
    "https://x.com/?hl=", "https://x.com/?hl=pt%2DBR", "https://x.com/?a=1;hl=pt",
    "https://www.bbc.com/portuguese/1", "http://x.br/a b", "http://a_b.br/", "g1.globo.com/x",
    "http://[bad", "http://bad]/x", "http://[::1]:80/x;p?a=b",
    "//u:p@Host.br:1/p;x/q;y?k=v&k=w&z#f?x=1", "", "http:", "http://", "mailto:a@b.pt",
    "http://a@b@c.pt/x", "HTTP://X.PT", "  http://x.pt/\n?l=1", "http://x.pt?hl=pt",
    "http://x.pt#?hl=pt", "/only/path;a;b", "a;b;c", "http://x.pt/a;b/c;d;e",
    "http://x/?a=b=c&d&=e&f=%zz&g=a+b&h=%C3%A7", "http://x.pt/é?hl=PT", "http://x;y.pt/z",
    "1http://x.pt/", "ht-tp+.1://x.pt/p", "http:///nohost", "http:/one", "http://x.pt:/",
    "http://x.pt/?", "http://x.pt/??hl=pt", "http://x/?hl=a%26b", "http://x/?%68l=pt",
    "x://y:z:1/p", "http://a[b]c/x", "?hl=pt", "#f", "http://x.com/p?x=[1]",
    "http://x.com/[a]", "http://u[x@h.br/",
    "http://x.pt/a\u2028b?hl=p\x85t#c\u2028d", "http://x.pt/a\x85",
]


def expected(url):
    try:
        parsed = urlparse(url)
        pairs = parse_qs(parsed.query)
        return (parsed.hostname or "").lower(), parsed.path.lower(), pairs
    except ValueError:
        return "", "", {}


def found(one, texts):
    out = []
    for parts in one(texts, urls.url_parts(urls.url_pieces(F.col("v")))):
        pairs = {}
        for pair in parts.query:
            pairs.setdefault(pair.key, []).append(pair.value)
        out.append((parts.host, parts.path, pairs))
    return out


def test_odd_addresses(one):
    for url, got in zip(ODD, found(one, ODD)):
        assert got == expected(url), url


def test_null_address(one):
    assert found(one, [None]) == [("", "", {})]


pieces = st.text("abzAZ09.-_~/;:?#&=+ é", max_size=12)


@settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(st.lists(st.tuples(st.sampled_from(["http://", "//", "", "https:"]), pieces, pieces),
                min_size=40, max_size=40))
def test_any_address(one, parts):
    texts = [scheme + a + "/" + b for scheme, a, b in parts]
    for url, got in zip(texts, found(one, texts)):
        assert got == expected(url), url


PREDICATES = {
    "https://www.globo.com/x": False,
    "https://G1.GLOBO.com/x": True,
    "https://x.pt/": True,
    "https://x.com.br:8080/": True,
    "https://x.com/?LANG=pt-PT": True,
    "https://x.com/?hl=pt_BR": False,
    "https://x.com/?hl=": False,
    "https://x.com/?hl=pt%2DBR": True,
    "https://x.com/?a=1;hl=pt": False,
    "https://www.bbc.com/portuguese/1": True,
    "http://x.br/a b": True,
    "http://a_b.br/": True,
    "g1.globo.com/x": False,
    "http://[bad": False,
    "https://x.com/?lang=éptico": False,
    "https://x.com/?lang=en&locale=PT": True,
}


def test_portuguese_addresses(one):
    mask = language.url_mask(F.col("v"), (language.PORTUGUESE,))
    assert dict(zip(PREDICATES, one(list(PREDICATES), mask))) == PREDICATES


def test_translation_note(one):
    notes = {
        "srclc:por;eng:GT-POR 1.0": "POR",
        "SRCLANG= Por": "POR",
        "a src_lc:spa b srclc:por": "SPA",
        "xsrclc:por": "",
        "srclc:port": "",
        "": "",
        None: "",
    }
    assert one(list(notes), language.source_language(F.col("v"))) == list(notes.values())


def test_place(one):
    places = {"1#Brazil#BR": True, "Brazilian": True, "x BRA;": True, "bra": True,
              "BRA_1": False, "BRAS": False, "": False, None: False}
    assert one(list(places), language.in_brazil(F.col("v"))) == list(places.values())


@pytest.mark.parametrize(
    "argument, wanted",
    [
        (None, set()), ("", set()), ('""', set()), ("''", set()), (" POR ", {"POR"}),
        ('"por,eng"', {"POR", "ENG"}), ("por, ,spa", {"POR", "SPA"}),
    ],
)
def test_language_argument(argument, wanted):
    assert language.wanted_languages(argument) == wanted
    assert language.wanted_languages() == {"POR"}


def test_rule_without_hints(one):
    rule = language.LanguageRule(code="XXX")
    assert one(["http://x.pt/?hl=pt"], language.url_mask(F.col("v"), (rule,))) == [False]


def test_lone_percent_signs_do_not_stop_decoding(one):
    query = "http://x.org/?hl=%70t%&a=%70t%ZZ&b=1%2&c=%C3%A9%+%"
    found = one([query], urls.url_parts(urls.url_pieces(F.col("v")))["query"])[0]
    assert [tuple(p) for p in found] == [("hl", "pt%"), ("a", "pt%ZZ"), ("b", "1%2"), ("c", "é% %")]
