"""Sources/sinks (A1-A5) and streaming jobs (H1-H5) against their batch equivalents."""

import os

from pyspark.sql import functions as F

from clickpath.operators import ingest as I
from clickpath.operators.derived import derived_events, rebuild_derived
from clickpath.sources import io
from clickpath.sources.bodies import bridge_bodies
from clickpath.sources.bridge import bridge_events
from clickpath.streaming import jobs

SF = "/root/testdata/sf0.001"


def test_raw_round_trip(spark, scratch):
    ev = bridge_events(spark, SF)
    io.write_raw(ev, scratch, "events")
    back = io.read_events(spark, scratch)
    assert back.count() == ev.count()
    cols = ["event_id", "event_name", "event_timestamp", "ingested_at", "anonymous_id", "session_id", "dt"]
    assert back.select(*cols).exceptAll(ev.select(*cols)).count() == 0
    assert back.where("params IS NOT NULL").first().params.startswith('{"gclid"')
    # dt is a partition column: a filter on it prunes directories
    plan = back.where(F.col("dt") == "2024-01-03")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_missing_bad_directory_is_empty(spark, scratch):
    assert io.read_bad(spark, scratch).count() == 0


def test_ingest_stream_matches_batch(spark, scratch):
    landing = os.path.join(scratch, "landing")
    bodies = bridge_bodies(spark, SF).where("decode_error IS NULL").select("body")
    bodies.coalesce(3).write.text(landing)
    q = jobs.ingest_stream(spark, landing, scratch + "/sink", scratch + "/ckpt", trigger={"availableNow": True})
    q.awaitTermination(300)
    good = io.read_events(spark, scratch + "/sink")
    bad = io.read_bad(spark, scratch + "/sink")
    batch = I.ingest(spark.read.text(landing).select(F.col("value").alias("body"),
                                                      F.current_timestamp().alias("received_at"))).cache()
    n_good = batch.where("good").count()
    assert good.count() == n_good
    assert bad.count() == batch.where("NOT good").count()
    assert good.count() + bad.count() == batch.count()      # nothing lost


def test_sinks_share_one_layout(spark, scratch):
    """A streaming sink, an append and a replay of bad rows stay readable together."""
    landing, pixels = scratch + "/landing", scratch + "/pixels"
    ok = '{"schema_version":"0","event_name":"page_view","event_timestamp":"2026-07-28T12:00:00Z","anonymous_id":"anon_0000001","session_id":"1785240000"}'
    spark.createDataFrame([(ok,), (ok.replace("page_view", "Bad"),)], "value string").coalesce(1).write.text(landing)
    import base64
    spark.createDataFrame([(base64.urlsafe_b64encode(ok.encode()).decode().rstrip("="),), ("%%%",)], "value string").coalesce(1).write.text(pixels)
    jobs.ingest_stream(spark, landing, scratch + "/sink", scratch + "/ckpt", trigger={"availableNow": True}, pixels=pixels).awaitTermination(300)
    assert io.read_events(spark, scratch + "/sink").count() == 2 and io.read_bad(spark, scratch + "/sink").count() == 2
    io.write_raw(io.read_events(spark, scratch + "/sink"), scratch + "/sink", "events")
    io.write_raw(I.replay_bad(io.read_bad(spark, scratch + "/sink")), scratch + "/sink", "events", "replay-1")
    assert io.read_events(spark, scratch + "/sink").count() == 4


def test_replay_adds_fixed_rows_once(spark, scratch):
    """Rows fixed since (an object, and text that once failed) come back once, with and without an id."""
    import datetime as dt
    ok = '{"schema_version":"0","event_name":"page_view","event_timestamp":"2026-07-28T12:00:00Z","anonymous_id":"anon_0000001","session_id":"sess_00001"%s}'
    at = dt.datetime(2026, 7, 28, 12, 0, 1)
    rows = [(at, "c", ["once"], ok % "", None), (at, "c", ["once"], None, ok % ',"event_id":"evt_000001"'), (at, "c", ["still"], '{"a":1}', None), (at, "c", ["still"], None, "not json")]
    bad = spark.createDataFrame(rows, "ingested_at timestamp, collector_instance string, errors array<string>, payload string, payload_raw string")
    first = I.replay_bad(bad)
    assert sorted(str(r.event_id) for r in first.collect()) == ["None", "evt_000001"]
    io.write_raw(first, scratch, "events", "replay-1")
    assert I.replay_bad(bad, io.read_events(spark, scratch)).count() == 0


def test_bodies_of_several_lines(spark, scratch):
    os.makedirs(scratch + "/landing")
    with open(scratch + "/landing/a.txt", "w") as f:
        f.write('{"schema_version":"0",\n"event_name":"page_view","event_timestamp":"2026-07-28T12:00:00Z",\n"anonymous_id":"anon_0000001","session_id":"1785240000"}\n')
    jobs.ingest_stream(spark, scratch + "/landing", scratch + "/sink", scratch + "/ckpt", trigger={"availableNow": True}, whole_files=True).awaitTermination(300)
    assert io.read_events(spark, scratch + "/sink").count() == 1


def _stream(spark, scratch, name, batches, schema):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{scratch}/{name}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/{name}")


def test_live_dedup_drops_copies_and_keeps_late_ids(spark, scratch):
    t = [f"2026-07-28 {h:02d}:00:00" for h in range(24)]
    batches = [[("e1", t[1]), ("e1", t[1]), (None, t[1])], [("e2", t[20]), (None, t[1]), ("e1", t[1])], [("e3", t[2]), ("e2", t[20])]]
    stream = _stream(spark, scratch, "dedup", [[(i, x) for i, x in b] for b in batches], "event_id string, at string").withColumn("ingested_at", F.to_timestamp("at"))
    q = jobs.live_dedup(stream).writeStream.format("memory").queryName("dedup_out").trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert sorted(str(r.event_id) for r in spark.table("dedup_out").collect()) == ["None", "None", "e1", "e2", "e3"]


def test_live_quality_counts_rejects_and_all_buckets(spark):
    minute = "2026-07-28 12:00:30"
    skews = [-200_000, -1_000, 0, 1_000, 200_000]
    good = spark.createDataFrame([(minute, s, "e") for s in skews], "at string, s long, event_id string").select(
        F.to_timestamp("at").alias("ingested_at"), F.timestamp_seconds(F.unix_seconds(F.to_timestamp("at")) + F.col("s")).alias("event_timestamp"), "event_id")
    bad = spark.createDataFrame([(minute,)] * 3, "at string").select(F.to_timestamp("at").alias("ingested_at"))
    r = jobs.live_quality(good, bad).first()
    assert (r.events, r.rejected, r.reject_pct, r.with_event_id, r.untrusted_clock) == (5, 3, 37.5, 5, 2)
    assert [r[f"skew_bucket_{k}"] for k in range(5)] == [1] * 5


def test_incremental_rebuild_twice_and_as_a_stream(spark, scratch):
    raw_root, dest = scratch + "/raw", scratch + "/derived"
    ev = bridge_events(spark, SF)
    dts = sorted(r.dt.isoformat() for r in ev.select("dt").distinct().collect())
    io.write_raw(ev.where(F.col("dt").isin(dts[:-2])), raw_root, "events")
    rebuild_derived(io.read_events(spark, raw_root), dest)
    jobs.rebuild_stream(spark, raw_root, dest, scratch + "/ckpt").awaitTermination(300)
    io.write_raw(ev.where(F.col("dt").isin(dts[-2:])), raw_root, "events")
    jobs.rebuild_stream(spark, raw_root, dest, scratch + "/ckpt").awaitTermination(300)
    jobs.incremental_rebuild(spark, raw_root, dest, dts[-2:])
    full = derived_events(io.read_events(spark, raw_root))
    cols = ["event_id", "anonymous_id", "event_time", "ingested_at", "event_date"]
    inc = spark.read.parquet(dest)
    assert inc.count() == full.count() and inc.select(*cols).exceptAll(full.select(*cols)).count() == 0


def test_incremental_rebuild_equals_full(spark, scratch):
    raw_root = scratch + "/raw"
    ev = bridge_events(spark, SF)
    io.write_raw(ev, raw_root, "events")
    dts = sorted(r.dt.isoformat() for r in ev.select("dt").distinct().collect())
    dest = scratch + "/derived"
    first, rest = dts[: len(dts) // 2], dts[len(dts) // 2:]
    rebuild_derived(io.read_events(spark, raw_root).where(F.col("dt").isin(first)), dest)
    jobs.incremental_rebuild(spark, raw_root, dest, rest)
    inc = spark.read.parquet(dest)
    full = derived_events(io.read_events(spark, raw_root))
    cols = ["event_id", "anonymous_id", "event_time", "ingested_at", "event_date"]
    assert inc.count() == full.count()
    assert inc.select(*cols).exceptAll(full.select(*cols)).count() == 0


EVENT_LINE = '{"schema_version":"0","event_id":"%s","event_name":"page_view","event_timestamp":"%s","ingested_at":"%s","anonymous_id":"anon_0000001","session_id":"sess_00001","device":{"platform":"web","screen_width":%s},"params":{"a":%s}}'
AT = "2026-07-28T12:00:00Z"


def _raw_lines(scratch, stream, lines):
    os.makedirs(f"{scratch}/{stream}/batch=b/dt=2026-07-28")
    with open(f"{scratch}/{stream}/batch=b/dt=2026-07-28/a.txt", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_partly_readable_lines_are_rows_whatever_is_read(spark, scratch):
    import datetime as dt
    at = dt.datetime(2026, 7, 28, 12)
    given = {"good": (AT, "1280", "1"), "whole": (AT, "1280.0", "1"), "over": (AT, "99999999999999999999", "1"), "part": (AT, "1.5", "1"),
             "lower": (AT.lower(), "5", "1"), "when": ("noon", "5", "1"), "long": (AT, "5", "1" * 2000)}
    lines = {k: EVENT_LINE % (k, v[0], AT, *v[1:]) for k, v in given.items()}
    cut = lines["good"][:-4]
    _raw_lines(scratch, "events", [*lines.values(), "not json", "", cut, "5", "null", "[1,2]", "[%s,%s]" % (lines["good"].replace("good", "one"), lines["whole"].replace("whole", "two"))])
    back = io.read_events(spark, scratch)
    full = {r.event_id: r for r in back.collect()}
    assert {k: (r.event_timestamp, r.device.screen_width) for k, r in full.items() if k in given} == {
        "good": (at, 1280), "whole": (at, 1280), "over": (at, None), "part": (at, None), "lower": (at, 5), "when": (None, 5), "long": (at, 5)}
    assert set(full) == {*given, "one", "two"} and full["long"].params == '{"a":%s}' % ("1" * 2000)
    n = len(full)
    assert back.count() == n and back.where("dt = '2026-07-28'").count() == n
    for column in (*back.columns, "device.screen_width", "page.url"):
        assert len(back.select(column).collect()) == n, column
    assert {r.event_id for r in back.select("event_id").collect()} == set(full)
    assert [r.event_id for r in back.where("event_timestamp is null").select("event_id").collect()] == ["when"]
    assert [r.event_id for r in back.where("event_id = 'over'").collect()] == ["over"]
    assert sorted(r.value for r in io.read_dropped(spark, scratch).collect()) == sorted(["not json", cut, "5", "null", "[1,2]"])


def test_partly_readable_rejects_are_rows(spark, scratch):
    assert io.read_dropped(spark, scratch, "bad").count() == 0
    _raw_lines(scratch, "bad", ['{"ingested_at":"noon","errors":["e"],"payload":{"a":1,"a":2}}', '{"ingested_at":"%s","errors":"e","payload":"x"}' % AT.lower(), "{"])
    back = io.read_bad(spark, scratch)
    assert sorted((str(r.ingested_at), r.payload) for r in back.collect()) == [("2026-07-28 12:00:00", '"x"'), ("None", '{"a":2}')]
    assert back.count() == 2 and all(len(back.select(c).collect()) == 2 for c in back.columns)
    assert [r.value for r in io.read_dropped(spark, scratch, "bad").collect()] == ["{"]


def test_rebuild_keeps_rows_without_a_readable_time(spark, scratch):
    """They stand under a NULL date, which a later fold that touches it must not lose or double."""
    raw_root, dest = scratch + "/raw", scratch + "/derived"
    line = EVENT_LINE % ("%s", AT, "%s", "1280.0", "1")
    _raw_lines(raw_root, "events", [line % ("evt_000001", AT), line % ("evt_000002", "noon"), (line % ("", "noon")).replace('"event_id":"",', "")])
    assert rebuild_derived(io.read_events(spark, raw_root), dest)["raw_events"] == 3
    os.makedirs(raw_root + "/events/batch=c/dt=2026-07-29")
    with open(raw_root + "/events/batch=c/dt=2026-07-29/a.txt", "w") as f:
        f.write(line % ("evt_000003", "noon") + "\n")
    for dates in (["2026-07-29"], ["2026-07-28"], ["2026-07-28", "2026-07-29"]):
        jobs.incremental_rebuild(spark, raw_root, dest, dates)
        assert sorted(str(r.event_id) for r in spark.read.parquet(dest).collect()) == ["None", "evt_000001", "evt_000002", "evt_000003"]
