"""Ingest does each step once, and only for the rows that need it."""

import datetime as dt
import json
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from clickpath.functions import redaction
from clickpath.operators import ingest as I
from clickpath.sources import io
from clickpath.streaming.jobs import ingest_stream

NOW = dt.datetime(2026, 7, 28, 12, 0, 0)
BASE = {"schema_version": "0", "event_name": "page_view", "event_timestamp": "2026-07-28T12:00:00Z",
        "anonymous_id": "anon_00000001", "session_id": "1785240000"}


def bodies(spark, *texts):
    return spark.createDataFrame([(x, NOW) for x in texts], "body string, received_at timestamp")


@pytest.fixture
def shipped(spark, monkeypatch):
    """Texts that the redaction UDF has been handed."""
    seen, redacted = spark.sparkContext.accumulator(0), redaction.redacted_json

    @pandas_udf("string")
    def counting(texts: pd.Series) -> pd.Series:
        seen.add(int(texts.notna().sum()))
        return texts.map(redacted)

    monkeypatch.setattr(redaction, "_deep_redact", counting)
    return seen


def test_events_are_not_rendered_as_payloads_of_no_object(spark, shipped):
    """A rejected event with a secret word in its URL, and a list that holds a secret."""
    bad = json.dumps(BASE | {"event_name": "Upper", "page": {"url": "https://x.com/?token=1"}})
    rows = I.bad_rows(I.ingest(bodies(spark, bad, '[[{"password":"p"}]]'))).collect()
    assert shipped.value == 1
    assert sorted(r.payload for r in rows)[0] == '[{"password":"<REDACTED>"}]'
    assert json.loads(sorted(r.payload for r in rows)[1]) == json.loads(bad)


def test_replay_judges_a_row_once(spark, shipped):
    rows = [(json.dumps(BASE | {"event_id": f"evt_0000000{k}", "params": {"auth_token": "<REDACTED>"}}), None, NOW, "c") for k in range(3)]
    bad = spark.createDataFrame(rows, "payload string, payload_raw string, ingested_at timestamp, collector_instance string")
    known = I.replay_bad(bad.where(F.col("payload").contains("evt_00000000")))
    known = spark.createDataFrame(known.collect(), known.schema)
    shipped.value = 0
    assert sorted(r.event_id for r in I.replay_bad(bad, known).collect()) == ["evt_00000001", "evt_00000002"]
    assert shipped.value == 3


def test_only_arrays_are_cut_into_elements(spark):
    texts = ["[1,[2],{}]", "[]", "{}", '"[1]"', "7", "null", "true", "[", "1.5", None]
    found = I.decode_bodies(bodies(spark, *texts)).select("body", "elem_pos", F.to_json("elem").alias("j")).collect()
    by_body = {t: [r.j for r in sorted(found, key=lambda r: r.elem_pos) if r.body == t] for t in texts}
    assert by_body == {"[1,[2],{}]": ["1", "[2]", "{}"], "[]": [], "{}": ["{}"], '"[1]"': ['"[1]"'], "7": ["7"], "null": ["null"],
                       "true": ["true"], "[": [None], "1.5": ["1.5"], None: [None]}


def test_no_method_too_long_for_the_jvm_to_compile(spark):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    I.ingest(bodies(spark, "{}"))
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_rows_are_kept_beside_a_udf(spark):
    """Beside a UDF Spark would keep a whole partition's rows; they pass through Python once instead."""
    plan = plan_of(I.ingest(bodies(spark, "{}")))
    assert "EvalPython" not in plan
    assert plan.count("MapInArrow") == 1


def test_redaction_by_rows_equals_the_udf(spark):
    texts = ['{"auth_token":"x","n":1.50}', '{"a":[{"password":{"b":1}},{"secret":""}]}', '{"plan":"pro"}', "null", '"s apikey=q"', '[1,"\\u0074oken"]', None]
    rows = spark.createDataFrame([(k, t, NOW) for k, t in enumerate(texts * 3)], "k int, t string, at timestamp")
    got = redaction.with_redacted(rows, "t", "r").collect()
    want = rows.withColumn("r", redaction.redact_json(F.col("t"))).collect()
    assert sorted(got) == sorted(want)


def test_known_rows_are_not_sent_to_the_driver(spark, scratch):
    """Of compressed lines Spark knows the files' size alone."""
    io.write_raw(I.good_events(I.ingest(bodies(spark, json.dumps(BASE | {"event_id": "evt_00000001"})))), scratch, "events", compression="gzip")
    bad = spark.createDataFrame([(json.dumps(BASE), None, NOW, "c")], "payload string, payload_raw string, ingested_at timestamp, collector_instance string")
    found = I.replay_bad(bad, io.read_events(spark, scratch))
    assert "BroadcastHashJoin" not in plan_of(found) and "BroadcastNestedLoopJoin" not in plan_of(found)
    assert found.count() == 1


def test_lines_are_written_unsorted_and_may_be_compressed(spark, scratch):
    given = [(json.dumps(BASE | {"event_id": f"evt_0000000{k}"}), NOW + dt.timedelta(days=k % 3)) for k in range(9)]
    made = I.ingest(spark.createDataFrame(given, "body string, received_at timestamp"))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    io.write_raw(I.good_events(made), scratch, "events", "a", "gzip")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    files = [str(f) for f in (Path(scratch) / "events").rglob("part-*")]
    assert files and all(f.endswith(".txt.gz") for f in files)
    assert sorted((r.event_id, r.dt) for r in io.read_events(spark, scratch).collect()) == [(f"evt_0000000{k}", (NOW + dt.timedelta(days=k % 3)).date()) for k in range(9)]


def test_a_streams_batch_is_not_held_in_memory(spark, scratch, monkeypatch):
    """Judged once, kept as a table until its writes are done, and compressed where it is asked for."""
    held, judged, ingest = [], [], I.ingest
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda self, *a: held.append(1) or self)
    monkeypatch.setattr(I, "ingest", lambda *a: judged.append(1) or ingest(*a))
    landed = Path(scratch) / "landed"
    landed.mkdir()
    (landed / "a.txt").write_text(json.dumps(BASE) + "\n" + json.dumps(BASE | {"event_name": "Upper"}) + "\n{\n")
    ingest_stream(spark, str(landed), f"{scratch}/sink", f"{scratch}/checkpoint", {"availableNow": True}, compression="gzip").awaitTermination()
    assert not held and len(judged) == 1
    assert sorted(p.name for p in (Path(scratch) / "sink").iterdir()) == ["bad", "counts", "events", "quality"]
    counts = io.read_counts(spark, f"{scratch}/sink").collect()
    assert [(r.bodies, r.received, r.accepted, r.rejected) for r in counts] == [(3, 3, 1, 2)]
    assert io.read_events(spark, f"{scratch}/sink").count() == 1 and io.read_bad(spark, f"{scratch}/sink").count() == 2
    assert all(str(f).endswith(".txt.gz") for f in (Path(scratch) / "sink/events").rglob("part-*"))
