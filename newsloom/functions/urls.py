"""URL parts and the three tests on them, all JVM-side.

``parse_url`` is no help: it raises under ANSI, and its ``try_`` form gives
null for a blank in the path or an underscore in the host, which still have a
host here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_QUERY = "array<struct<key:string,value:string>>"


# One pass over the address. Groups: host in brackets or plain host, path behind a
# host or without one (up to the parameters of its last segment), query. Brackets
# other than around the whole host match nothing. Parameters are cut from every
# path, as is right for web addresses.
ADDRESS = (
    r"(?s)^[\x00-\x20]*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?+"
    r"(?://(?:[^\[\]/?#]*@)?(?:\[([^\]/?#]*)\](?::[^/?#]*)?|([^:\[\]/?#]*)(?::[^\[\]/?#]*)?)"
    r"((?:/(?:[^?#]*/)?[^;/?#]*)?)"
    r"|(?!//)((?:[^?#]*/)?[^;/?#]*))"
    r"(?:;[^/?#]*)?(?:\?([^#]*))?(?:#.*)?\z"
)
HOST, PATH, QUERY = 1, 2, 3


def url_pieces(url: Column) -> Column:
    """``['', host, path, query]`` as written, or one item if unreadable.

    Line breaks and tabs do not count in an address, so one can mark the cuts.
    """
    given = F.coalesce(url, F.lit(""))
    broken = any_of(F.contains(given, F.lit(mark)) for mark in "\t\r\n")
    plain = F.when(broken, F.translate(given, "\t\r\n", "")).otherwise(given)
    return F.split(F.regexp_replace(plain, ADDRESS, "\n$1$2\n$3$4\n$5"), "\n")


def _piece(pieces: Column, place: int) -> Column:
    return F.coalesce(F.get(pieces, F.lit(place)), F.lit(""))


def _decoded(text: Column) -> Column:
    """Escapes decoded; a percent sign that begins none stands for itself."""
    lone = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(lone), F.translate(text, "+", " "))


def _query_pairs(query: Column) -> Column:
    """Key and value of every ``key=value`` piece; a piece without a value is dropped."""
    whole = F.filter(F.split(query, "&"), lambda p: F.rlike(p, F.lit("(?s)=.")))

    def pair(piece: Column) -> Column:
        key = F.substring_index(piece, "=", 1)
        value = F.substring(piece, F.length(key) + 2, F.length(piece))
        return F.struct(_decoded(key).alias("key"), _decoded(value).alias("value"))

    return F.when(query == "", F.array().cast(NO_QUERY)).otherwise(F.transform(whole, pair))


def url_parts(pieces: Column) -> Column:
    """``struct<host, path, query>`` of ``url_pieces``; all empty if unreadable."""
    return F.struct(
        F.lower(_piece(pieces, HOST)).alias("host"),
        F.lower(_piece(pieces, PATH)).alias("path"),
        _query_pairs(_piece(pieces, QUERY)).alias("query"),
    )


def on_url(url: Column, test: Callable[[Column], Column]) -> Column:
    """A test on the parts of an address, which is taken apart once.

    A lambda variable is worked out once per row; the alias of a projection is
    not, because a filter above it is pushed below it with the expression
    written out at every use.
    """
    return F.exists(
        F.array(url_pieces(url)), lambda pieces: F.exists(F.array(url_parts(pieces)), test)
    )


def any_of(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _literals(texts: Iterable[str]) -> str:
    return "(?:" + "|".join(r"\Q" + t + r"\E" for t in texts) + ")"


def host_test(host: Column, suffixes: Iterable[str], hosts: Iterable[str]) -> Column:
    """Ends in one of the suffixes, or is exactly one of the hosts."""
    suffixes, hosts = list(suffixes), list(hosts)
    listed = host.isin(hosts) if hosts else F.lit(False)
    return (F.rlike(host, F.lit(_literals(suffixes) + r"\z")) | listed) if suffixes else listed


def query_test(query: Column, keys: Iterable[str], value_pattern: str) -> Column:
    """One of the keys (any case) has a value that matches the pattern."""
    wanted = [k.lower() for k in keys]

    def hit(pair: Column) -> Column:
        return F.lower(pair["key"]).isin(wanted) & F.rlike(
            F.lower(pair["value"]), F.lit(value_pattern)
        )

    return F.exists(query, hit)


def section_test(host: Column, path: Column, hints: Iterable[str]) -> Column:
    """Host and path together contain one of the hints."""
    hints = list(hints)
    if not hints:
        return F.lit(False)
    return F.rlike(F.concat(host, path), F.lit(_literals(hints)))
