"""The contract compiled from a JSON Schema (B6): same rules as the fixed table, and further versions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickpath.operators import ingest as I
from clickpath.operators.contract import V0, compile_schema

TEXT = {"type": ["string", "null"]}
LONG = {"type": ["string", "null"], "maxLength": 250}
KEY = {"type": "string", "minLength": 8, "maxLength": 64}
TIME = {"type": "string", "format": "date-time"}
FIRST = {
    "title": "event", "type": "object", "additionalProperties": False,
    "required": ["schema_version", "event_name", "event_timestamp", "anonymous_id", "session_id"],
    "properties": {
        "schema_version": {"const": "0"}, "event_id": KEY, "event_name": {"type": "string", "pattern": "^[a-z][a-z0-9_]{0,39}$"},
        "event_timestamp": TIME, "ingested_at": TIME, "anonymous_id": KEY, "session_id": KEY, "user_id": {"type": ["string", "null"], "maxLength": 128},
        "page": {"type": "object", "additionalProperties": False, "properties": {"url": {"type": "string"}, "path": {"type": "string"}, "title": {"type": "string"}, "referrer": TEXT}},
        "campaign": {"type": "object", "additionalProperties": False, "properties": {
            **{k: LONG for k in ("source", "medium", "campaign", "content", "term")}, "attribution": {"enum": ["first_touch", "last_touch"]}}},
        "device": {"type": "object", "additionalProperties": False, "properties": {
            "platform": {"enum": ["web", "android", "ios", "server"]}, "user_agent": TEXT, "language": TEXT,
            "screen_width": {"type": ["integer", "null"]}, "screen_height": {"type": ["integer", "null"]}}},
        "params": {"type": "object", "maxProperties": 25, "additionalProperties": {"type": ["string", "number", "boolean", "null"]}},
    },
}


def test_compiled_rules_are_the_fixed_ones():
    made = compile_schema(FIRST)
    assert (made.root_fields, made.required, made.closed_objects, made.param_types) == (V0.root_fields, V0.required, V0.closed_objects, V0.param_types)
    assert made.field_rules == V0.field_rules


@pytest.mark.parametrize("change", [{"additionalProperties": True}, {"oneOf": []}, {"properties": {"a": {"type": "string", "format": "email"}}},
                                    {"properties": {"a": {"type": "array", "items": {}}}}, {"properties": {"a": {"type": "object", "properties": {}, "additionalProperties": True}}}])
def test_what_cannot_be_expressed_is_an_error(change):
    with pytest.raises(ValueError):
        compile_schema({**FIRST, **change})


def test_two_versions_in_one_batch(spark):
    second = {**FIRST, "required": ["schema_version", "event_name"], "properties": {**FIRST["properties"], "schema_version": {"const": "1"}, "tenant": {"type": "string", "minLength": 3}}}
    event = '{"schema_version":"%s","event_name":"page_view","event_timestamp":"2026-07-28T12:00:00Z","anonymous_id":"anon_0000001","session_id":"sess_00001"%s}'
    bodies = [event % ("0", ""), event % ("0", ',"tenant":"abc"'), event % ("1", ',"tenant":"abc"'), event % ("1", ',"tenant":"ab"'),
              '{"schema_version":"1","event_name":"Bad"}', event % ("7", "")]
    df = spark.createDataFrame([(b, dt.datetime(2026, 7, 28, 12)) for b in bodies], "body string, received_at timestamp")
    got = I.process(I.decode_bodies(df), {"1": compile_schema(second)}).select("errors", F.coalesce("payload", F.to_json("event")).alias("p")).collect()
    assert sorted(r.errors for r in got) == sorted([
        [], ["<root>: Additional properties are not allowed ('tenant' was unexpected)"], [], ["tenant: 'ab' is too short"],
        ["event_name: 'Bad' does not match '^[a-z][a-z0-9_]{0,39}$'"], ["schema_version: '0' was expected"]])
