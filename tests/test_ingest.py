"""Ingest (B1-B9): the reference's contract cases, redaction bypasses and the fork invariant."""

import datetime as dt
import json
from dataclasses import replace

from pyspark.sql import functions as F

from clickpath.operators import ingest as I
from clickpath.operators.contract import V0

NOW = dt.datetime(2026, 7, 28, 12, 0, 0, 123456)
BASE = {"schema_version": "0", "event_name": "page_view", "event_timestamp": "2026-07-28T12:00:00Z",
        "anonymous_id": "anon_00000001", "session_id": "1785240000"}


def ev(**kw):
    d = dict(BASE)
    for k, v in kw.items():
        if v is None and k.startswith("-"):
            continue
        d[k] = v
    for k in [k for k in kw if k.startswith("-")]:
        d.pop(k[1:], None)
    return d


CASES = [  # (label, event, good?)
    ("required only", ev(), True),
    ("event_id absent", ev(), True),
    ("event_id 4 chars", ev(event_id="abcd"), False),
    ("all optional objects", ev(event_id="evt_00000001", user_id="u1",
                                page={"url": "https://x.com/a?b=1", "path": "/a", "title": "A", "referrer": None},
                                campaign={"source": "google", "medium": "cpc", "campaign": "c", "content": None,
                                          "term": None, "attribution": "first_touch"},
                                device={"platform": "web", "user_agent": "ua", "language": "en",
                                        "screen_width": 1280, "screen_height": 720},
                                params={"plan": "pro", "n": 1, "ok": True, "none": None}), True),
    ("client ingested_at 1999", ev(ingested_at="1999-01-01T00:00:00Z"), True),
    ("secret params", ev(params={"auth_token": "t", "apikey": "k", "magiclink_token": "m", "plan": "pro"}), True),
    ("server platform", ev(device={"platform": "server", "user_agent": "curl/8"}), True),
    ("session_id missing", ev(**{"-session_id": None}), False),
    ("upper-case name", ev(event_name="Page_View"), False),
    ("unknown root field", ev(colour="red"), False),
    ("nested param", ev(params={"a": {"b": 1}}), False),
    ("schema_version 1", ev(schema_version="1"), False),
    ("bad timestamp", ev(event_timestamp="yesterday"), False),
    ("anonymous_id 3 chars", ev(anonymous_id="abc"), False),
    ("attribution enum", ev(campaign={"attribution": "middle_touch"}), False),
    ("platform enum", ev(device={"platform": "tv"}), False),
]


def test_contract_cases(spark):
    """All cases as one array body: element position identifies the case."""
    body = json.dumps([c[1] for c in CASES])
    rows = I.ingest(spark.createDataFrame([(body, NOW)], "body string, received_at timestamp")).collect()
    assert len(rows) == len(CASES)
    by_pos = {r.elem_pos: r for r in rows}
    for i, (label, _, good) in enumerate(CASES):
        assert by_pos[i].good == good, (label, by_pos[i].errors)
    assert any("'session_id' is a required property" in e for e in by_pos[7].errors)
    assert any("does not match" in e for e in by_pos[8].errors)
    assert any("Additional properties are not allowed ('colour' was unexpected)" in e for e in by_pos[9].errors)


def test_stamp_overwrites_client_value(spark):
    one = spark.createDataFrame([(json.dumps(ev(ingested_at="1999-01-01T00:00:00Z")), NOW)],
                                "body string, received_at timestamp")
    g = I.good_events(I.ingest(one)).first()
    assert g.ingested_at == dt.datetime(2026, 7, 28, 12, 0, 0, 123000)   # ms, truncated
    assert g.dt == dt.date(2026, 7, 28)


def test_redaction(spark):
    params = {"auth_token": "t", "apikey": "k", "magiclink_token": "m", "plan": "pro", "x-api-key": "z",
              "empty_token": "", "zero_password": 0, "list": [{"secret": "s"}]}
    body = json.dumps(ev(params=params))
    r = I.ingest(spark.createDataFrame([(body, NOW)], "body string, received_at timestamp")).first()
    p = json.loads(r.params)
    assert p["auth_token"] == p["apikey"] == p["magiclink_token"] == p["x-api-key"] == "<REDACTED>"
    assert p["plan"] == "pro" and p["empty_token"] == "" and p["zero_password"] == "<REDACTED>"
    assert p["list"] == [{"secret": "<REDACTED>"}]
    assert not r.good  # the list param is not a flat scalar -> bad, but stored redacted
    assert "<REDACTED>" in r.payload and '"s"' not in r.payload


def test_redaction_bypasses(spark):
    bodies = [
        '[[{"api_key": "k1"}], "token=abc"]',                                 # list payload, str element
        '{"params": {"auth": {"token": "deep"}}, "schema_version": "0"}',     # nested object
        '{"truncated": "x", "password": "hunter2", "apikey=',                 # unparseable text
    ]
    rows = I.ingest(spark.createDataFrame([(b, NOW) for b in bodies], "body string, received_at timestamp")).collect()
    text = " ".join((r.payload or "") + (r.payload_raw or "") for r in rows)
    for secret in ("k1", "abc", "deep", "hunter2"):
        assert secret not in text
    assert all(not r.good for r in rows)


def test_fork_is_lossless(spark):
    bodies = [json.dumps(c[1]) for c in CASES] + ["{not json", "[]", "[1, 2]", "null"]
    p = I.ingest(spark.createDataFrame([(b, NOW) for b in bodies], "body string, received_at timestamp"))
    n_good, n_bad = I.good_events(p).count(), I.bad_rows(p).count()
    assert n_good + n_bad == len(CASES) + 1 + 0 + 2 + 1
    assert n_good == sum(1 for c in CASES if c[2])


def test_pixel_decoding(spark):
    import base64
    raw = base64.urlsafe_b64encode(json.dumps(ev()).encode()).decode().rstrip("=")
    px = spark.createDataFrame([(raw, NOW), ("", NOW), ("%%%", NOW)], "e string, received_at timestamp")
    rows = I.ingest(I.decode_pixel(px)).orderBy("elem_pos").collect()
    assert sorted(r.good for r in rows) == [False, False, True]
    errs = sorted(e for r in rows for e in r.errors)
    assert errs == sorted([I.PIXEL_EMPTY_MESSAGE, I.PIXEL_BAD_MESSAGE])


def test_replay_after_fix(spark):
    bad = spark.createDataFrame([(NOW, "c1", ["x"], json.dumps(ev(event_id="evt_00000009")), None, NOW.date())],
                                "ingested_at timestamp, collector_instance string, errors array<string>, "
                                "payload string, payload_raw string, dt date")
    out = I.replay_bad(bad).collect()
    assert len(out) == 1 and out[0].event_id == "evt_00000009"
    assert I.replay_bad(bad, I.replay_bad(bad)).count() == 0


def test_replay_once_a_version_is_known(spark):
    later = replace(V0, field_rules=[(p, t, {"const": "1"} if p == "schema_version" else c) for p, t, c in V0.field_rules])
    sent = [json.dumps(ev(schema_version="1", event_id=f"evt_0000000{k}")) for k in (1, 2)] + [json.dumps(ev(schema_version="1", event_name="Bad")), json.dumps(ev(schema_version="2"))]
    processed = I.ingest(spark.createDataFrame([(b, NOW) for b in sent], "body string, received_at timestamp"))
    bad = I.bad_rows(processed)
    assert bad.count() == 4 and I.replay_bad(bad).count() == 0
    out = I.replay_bad(bad, versions={"1": later})
    assert sorted((r.event_id, r.schema_version, r.ingested_at) for r in out.collect()) == [(f"evt_0000000{k}", "1", NOW.replace(microsecond=123000)) for k in (1, 2)]
    assert I.replay_bad(bad, out, {"1": later}).count() == 0
