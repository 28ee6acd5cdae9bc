"""Analyses read back from responses."""

import pytest

from newsloom.operators import responses


@pytest.mark.parametrize(
    "response, kind, tom",
    [
        ('{"tom":"a"}', None, "a"),
        ('```json\n{"tom":"a","bordoes":[{"texto":"x","exemplo":null}]}\n```', None, "a"),
        ('{"tom":"a","tom":"b"}', None, "b"),
        ('{"tom":"a","confianca_global":NaN}', None, "a"),
        ('{"bordoes":"abc"}', responses.NOT_AN_OBJECT, None),
        ('{"confianca_global":"alta"}', responses.NOT_AN_OBJECT, None),
        ('{"temas_recorrentes":["x","y"]}', responses.NOT_AN_OBJECT, None),
        ('[{"tom":"a"}]', responses.NOT_AN_OBJECT, None),
        ("5", responses.NOT_AN_OBJECT, None),
        ("1,2", responses.NOT_JSON, None),
        ('{"tom":"a"', responses.NOT_JSON, None),
        ('{"tom":"a"} and more', responses.NOT_JSON, None),
        ("", responses.NOT_JSON, None),
        (None, responses.NO_RESPONSE, None),
        ('{"tom":"a"}] junk [', responses.NOT_JSON, None),
        ('{"tom":"a"}],["x"', responses.NOT_JSON, None),
        ("{'tom':'a'}", responses.NOT_JSON, None),
        ('{"tom":"a"},"x":2', responses.NOT_JSON, None),
        ('{"tom":"a"},"_end":1', responses.NOT_JSON, None),
        ('{"tom":"a"}{"tom":"b"}', responses.NOT_JSON, None),
        ('{"tom":"a"}}', responses.NOT_JSON, None),
        ('{"tom":"a",}', responses.NOT_JSON, None),
        ('{"tom":"]} [{\\" junk"}', None, ']} [{" junk'),
        ('{"tom":"NaN, Infinity"}', None, "NaN, Infinity"),
        ('{"tom":1}', None, "1"),
        ('{"tom":true}', None, "true"),
        ('{"confianca_global":"0.5"}', responses.NOT_AN_OBJECT, None),
        ('{"confianca_global":1}', None, None),
        ('"{}"', responses.NOT_AN_OBJECT, None),
        ("null", responses.NOT_AN_OBJECT, None),
        ('{"tom":null}', None, None),
        (' \n{"tom":"a"}\n ', None, "a"),
    ],
)
def test_kinds_of_response(spark, response, kind, tom):
    rows = spark.createDataFrame([(response,)], "response string")
    found = responses.parsed(rows).first()
    assert (found.error and found.error.kind, found.analysis and found.analysis.tom) == (kind, tom)


def test_one_response_per_block(spark):
    blocks = spark.createDataFrame([("c", 0), ("c", 1)], "corpus_key string, block_no int")
    given = [("c", 0, '{"tom":"a"}'), ("c", 0, '{"tom":"b"} and more'), ("c", 0, "zzz"), ("c", 0, None), ("c", 0, '{"tom":"a"}')]
    table = spark.createDataFrame(given, "corpus_key string, block_no int, response string")
    found = sorted(responses.analyses(blocks, table).collect(), key=lambda r: r.block_no)
    assert [r.analysis and r.analysis.tom for r in found] == ["a", None]
    assert found[1].error.kind == responses.NO_RESPONSE
