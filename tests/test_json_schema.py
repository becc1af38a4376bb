"""Documents compiled to columns: the events' own, and others."""

import json

import pytest

from sessionrate.operators import parse as P
from sessionrate.operators.json_schema import compile_schema, event_document
from sessionrate.sources.adapter import game_records
from sessionrate.sources.kafka import decode_envelope

SF = "/root/testdata/sf0.001"
ORDER = json.dumps({
    "$id": "order", "title": "An order", "type": "object", "required": ["id", "lines"],
    "properties": {
        "id": {"type": "integer", "minimum": 1}, "state": {"enum": ["new", "paid", 3, None], "default": "new"},
        "price": {"type": "number", "maximum": 99.5, "default": 1.5}, "gift": {"type": "boolean", "default": False},
        "note": {"type": ["string", "null"], "minLength": 2, "maxLength": 4, "pattern": "^[a-z]"},
        "lines": {"type": "array", "items": {"type": "integer", "minimum": 0}, "default": [7]},
        "a b.c'd": {"type": "string"},
        "to": {"type": "object", "default": {"zip": "0"}, "required": ["city"],
               "properties": {"city": {"type": "string", "default": "?"}, "zip": {"type": "string"},
                              "geo": {"type": "object", "properties": {"x": {"type": "number"}}}}}}})


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, value string").repartition(2)


def check(spark, *texts):
    return [r.violations for r in compile_schema(ORDER).violations(frame(spark, texts)).orderBy("n").collect()]


def test_the_events_document_gives_the_librarys_checks(spark):
    env = decode_envelope(game_records(spark, SF, faults=True))
    got = compile_schema(event_document()).violations(env).select("offset", "violations")
    want = P.schema_violations(env).select("offset", "violations")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_the_events_document_gives_the_schema_profile(spark):
    env = decode_envelope(game_records(spark, SF)).drop("event_time")
    doc = compile_schema(event_document())
    want = P.parse_events(env, defaults="schema").drop(P.CORRUPT)
    cast = doc.read(env).selectExpr("key", "timestamp", "headers", "partition", "offset", *[
        f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in want.schema if f.name in doc.struct.names])
    assert cast.select(want.columns).exceptAll(want).count() == 0 and want.count() == 1000


def test_conforming(spark):
    full = {"id": 1, "state": "paid", "price": 99.5, "gift": True, "note": "ab", "lines": [0, 1], "a b.c'd": "x",
            "to": {"city": "B", "geo": {"x": 1}}, "more": [1]}
    assert check(spark, json.dumps(full), '{"id":12345678901234567890,"lines":[],"note":null,"state":null}') == [[], []]


@pytest.mark.parametrize("text, want", [
    ("{}", ["/id: required", "/lines: required"]),
    ('{"id":0,"lines":[1]}', ["/id: minimum 1"]),
    ('{"id":1.5,"lines":[1]}', ["/id: expected integer"]),
    ('{"id":"1","lines":"1"}', ["/id: expected integer", "/lines: expected array"]),
    ('{"id":1,"lines":[1,"x",-1]}', ["/lines/*: expected integer", "/lines/*: minimum 0"]),
    ('{"id":1,"lines":[],"state":"old"}', ['/state: not one of "new", "paid", 3, null']),
    ('{"id":1,"lines":[],"state":3,"price":100}', ["/price: maximum 99.5"]),
    ('{"id":1,"lines":[],"note":"a"}', ["/note: minLength 2"]),
    ('{"id":1,"lines":[],"note":"Abcde"}', ["/note: maxLength 4", "/note: pattern ^[a-z]"]),
    ('{"id":1,"lines":[],"note":5,"gift":"no"}', ["/gift: expected boolean", "/note: expected string or null"]),
    ('{"id":1,"lines":[],"a b.c\'d":1}', ["/a b.c'd: expected string"]),
    ('{"id":1,"lines":[],"to":{"zip":1,"geo":{"x":"a"}}}', ["/to/city: required", "/to/zip: expected string", "/to/geo/x: expected number"]),
    ('{"id":1,"lines":[],"to":5}', ["/to: expected object"]),
    ('{"id":1,"lines":[]} more', ["/: expected object"]), ("[1]", ["/: expected object"]), ("", ["/: expected object"]),
    (None, ["/: expected object"]), ("null", ["/: expected object"])])
def test_violations(spark, text, want):
    assert [sorted(x) for x in check(spark, text)] == [sorted(want)]


def test_read_with_defaults(spark):
    doc = compile_schema(ORDER)
    assert doc.struct.simpleString() == ("struct<id:bigint,state:string,price:double,gift:boolean,note:string,lines:array<bigint>,"
                                         "a b.c'd:string,to:struct<city:string,zip:string,geo:struct<x:double>>>")
    texts = ['{"id":4,"state":"paid","note":"x","lines":[1,"2"],"to":{"zip":"9","geo":{"x":2}}}', '{"id":"4","price":null,"to":{}}',
             '{"to":null,"lines":null}', "{}", "nonsense", '{"a b.c\'d":"q","gift":true,"state":3}']
    got = [tuple(r)[1:] for r in doc.read(frame(spark, texts)).orderBy("n").collect()]
    assert got[0] == (4, '"paid"', 1.5, False, "x", [1, None], None, ("?", "9", (2.0,)))
    assert got[1] == (None, '"new"', None, False, None, [7], None, ("?", None, None))
    assert got[2] == (None, '"new"', 1.5, False, None, None, None, None)
    assert got[3] == (None, '"new"', 1.5, False, None, [7], None, ("?", "0", None))
    assert got[4] == (None,) * 8 and got[5][1:4] == ("3", 1.5, True) and got[5][6] == "q"


@pytest.mark.parametrize("doc, match", [
    ({"type": "string"}, "root"), ({"type": "object", "oneOf": []}, "unsupported"), ({"type": "thing"}, "unknown types"),
    ({"type": "object", "properties": {"a": {"type": "object", "additionalProperties": False}}}, "/a: unsupported"),
    ({"type": "object", "properties": {"a": 5}}, "must be an object")])
def test_documents_that_are_refused(doc, match):
    with pytest.raises(ValueError, match=match):
        compile_schema(json.dumps(doc))


def test_no_rules(spark):
    assert [r.violations for r in compile_schema('{"type":"object"}').violations(frame(spark, ["{}", "1"])).orderBy("n").collect()] == [
        [], ["/: expected object"]]
