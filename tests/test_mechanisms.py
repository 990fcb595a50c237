"""Compaction (A4), access logs (A8), stream counts and quality (B8, H4), live sessions (H3), session states."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from clickpath.config import Config
from clickpath.operators import ingest as I
from clickpath.operators.sessions import derived_sessions, fold_sessions, read_sessions, sessions
from clickpath.plans import catalog
from clickpath.sources import compaction, io, layer
from clickpath.storage import run_folder, stored
from clickpath.streaming import jobs
from helpers import event, events_df

OK = '{"schema_version":"0","event_name":"page_view","event_timestamp":"2026-07-28T12:00:00Z","anonymous_id":"anon_0000001","session_id":"1785240000"}'


def _lines(scratch, batch, day, lines, done=True):
    folder = f"{scratch}/events/batch={batch}/dt=2026-07-{day}"
    os.makedirs(folder)
    with open(folder + "/a.txt", "w") as f:
        f.write("\n".join(lines) + "\n")
    if done:
        open(f"{scratch}/events/batch={batch}/_SUCCESS", "w").close()


def test_compaction_beside_writers_and_readers(spark, scratch):
    assert compaction.compact(spark, scratch)["batches"] == 0 and compaction.clean(spark, scratch) == 0
    for k in range(6):
        _lines(scratch, f"stream-{k}", 28 + k % 2, [OK, "not json", ""] * (k + 1))
    _lines(scratch, "by-hand", 28, [OK])
    _lines(scratch, "unfinished", 28, [OK], done=False)
    def seen():
        return sorted(map(str, io.read_events(spark, scratch).collect())), sorted(map(str, io.read_dropped(spark, scratch).select("value", "dt").collect()))

    want, reader = seen(), io.read_events(spark, scratch)
    stats = compaction.compact(spark, scratch)
    # The stream's last batch may be written again, and one batch is not finished: both stay.
    assert (stats["batches"], stats["files_before"], stats["files_after"]) == (6, 8, 4)
    assert seen() == want and reader.count() == len(want[0])
    assert compaction.compact(spark, scratch)["batches"] == 0                           # again: nothing to gain
    made = f"{scratch}/events/batch={compaction.PREFIX}dead"                            # an attempt that died before its commit
    os.makedirs(made + "/dt=2026-07-28")
    with open(made + "/dt=2026-07-28/a.txt", "w") as f:
        f.write(OK + "\n")
    assert seen() == want
    assert compaction.clean(spark, scratch) == 7 and seen() == want
    assert len(layer.folders(spark, scratch + "/events", "batch=")) == 3
    _lines(scratch, "stream-6", 29, [OK])
    assert len(seen()[0]) == len(want[0]) + 1
    assert io.read_events(spark, scratch).where("dt = '2026-07-28'").count() > 0


def test_access_log_lines(spark):
    at = '203.0.113.7 - frank [28/Jul/2026:14:00:01 +0200] '
    tail = ' 200 43 "https://x.example/?e=no" "agent (\\"q\\")"'
    good = {"GET /collect?e=YWI": "YWI", "GET /collect?v=1&e=YW%4A-_&x=2": "YWJ-_", "GET /collect?e=a&e=b%3D": "b=", "GET /collect?%65=c": "c", "GET /collect": "",
            "GET /collect?e=": "", "GET /collect?e": "", "GET /coll%65ct?e=%zz+d": "%zz+d", "GET /collect?xe=1": "", "GET /collect?e=f#e=g": "f"}
    lines = [f'{at}"{request} HTTP/1.1"{tail}' for request in good]
    lines += [at + '"GET /collect?e=old" 200 -', at + '"POST /collect HTTP/1.1" 200 2', at + '"GET /other?e=x HTTP/1.1" 404 0']
    rest = ["", "free text", at + '"-" 400 0', lines[0].replace("28/Jul", "32/Jul"), None]
    df = spark.createDataFrame([(x,) for x in lines + rest], "value string")
    got = I.log_pixels(df).collect()
    assert sorted(r.e for r in got) == sorted([*good.values(), "old"])
    assert {r.received_at for r in got} == {dt.datetime(2026, 7, 28, 12, 0, 1)}
    assert sorted(r.value for r in I.log_rest(df).collect()) == sorted(rest[1:4])


def test_stream_counts_and_quality_survive_a_restart(spark, scratch):
    def land(name, lines):
        os.makedirs(scratch + "/landing", exist_ok=True)
        with open(f"{scratch}/landing/{name}.txt", "w") as f:
            f.write("\n".join(lines) + "\n")

    sink = scratch + "/sink"
    assert io.read_counts(spark, sink).count() == 0 and jobs.read_quality(spark, sink).count() == 0
    for name, lines in (("a", [OK, "[%s,%s,5]" % (OK, OK), "no"]), ("b", [OK.replace("page_view", "Bad")])):
        land(name, lines)
        jobs.ingest_stream(spark, scratch + "/landing", sink, scratch + "/ckpt", trigger={"availableNow": True}).awaitTermination(300)
    counts = {r.batch: (r.bodies, r.received, r.accepted, r.rejected) for r in io.read_counts(spark, sink).collect()}
    assert counts == {"stream-0": (3, 5, 3, 2), "stream-1": (1, 1, 0, 1)}
    for r in io.read_counts(spark, sink).collect():
        assert io.read_events(spark, sink).count() == 3 and r.accepted + r.rejected == r.received
    quality = jobs.read_quality(spark, sink).agg(F.sum("events").alias("e"), F.sum("rejected").alias("r")).first()
    assert (quality.e, quality.r) == (3, 3)


def test_quality_parts_merge_to_the_whole(spark):
    rows = [event(event_id=None if k % 3 else f"evt_0000{k:03d}", ingested_at=f"2026-07-28T12:{k % 4:02d}:30Z", event_timestamp=f"2026-07-2{k % 9}T12:00:00Z") for k in range(40)]
    whole = jobs.live_quality(events_df(spark, rows)).orderBy("minute_start").collect()
    parts = jobs.quality_parts(events_df(spark, rows[:7])).unionAll(jobs.quality_parts(events_df(spark, rows[7:])))
    merged = jobs._with_rate(parts.groupBy("minute_start").agg(*(F.sum(c).alias(c) for c in parts.columns[1:]))).orderBy("minute_start").collect()
    assert merged == whole


def _stream(spark, folder, batches, schema):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_late_rows_of_windows_are_counted(spark, scratch):
    late = jobs.LateRows()
    spark.streams.addListener(late)
    try:
        schema = "ingested_at timestamp, event_timestamp timestamp, event_id string"
        at = [dt.datetime(2026, 7, 28, h) for h in (12, 20, 20, 12, 21)]     # a row is late by the watermark of the batch before
        stream = _stream(spark, scratch + "/rows", [[(t, t, "e")] for t in at], schema)
        q = jobs.live_quality(stream).writeStream.outputMode("update").format("memory").queryName("late_quality").trigger(availableNow=True).start()
        q.awaitTermination(300)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        assert late.dropped["late_quality"] == 1
    finally:
        spark.streams.removeListener(late)


def test_live_session_log_of_shuffled_rows_equals_the_batch(spark, scratch):
    rng = random.Random(11)
    start = dt.datetime(2026, 7, 28, 0, 0, 30)
    rows = [(f"v{rng.randrange(4)}", rng.choice(["s1", "s2", None]), start + dt.timedelta(seconds=rng.randrange(0, 60_000))) for _ in range(150)] + [("v0", "s9", None)]
    rng.shuffle(rows)
    schema = "anonymous_id string, session_id string, event_timestamp timestamp"
    log = jobs.live_session_log(_stream(spark, scratch + "/rows", [rows[:60], rows[60:90], rows[90:]], schema))
    log.writeStream.outputMode("update").format("memory").queryName("session_log").trigger(availableNow=True).start().awaitTermination(300)
    log = spark.table("session_log")
    timed = [r for r in rows if r[2]]
    full = events_df(
        spark, [event(anonymous_id=v, session_id=s, event_timestamp=t) for v, s, t in timed])
    want = derived_sessions(full, Config(chunks=2)).select("anonymous_id", "client_session_id", "distinct_client_session_ids", "session_start", "events")
    got = jobs.live_session_table(log)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 8
    assert [(r.kind, r.events) for r in log.where("kind <> 'session'").collect()] == [("untimed", 1)]


NOW = {"availableNow": True}


def test_session_log_job_started_again_equals_the_batch(spark, scratch):
    rng = random.Random(7)
    start = dt.datetime(2026, 7, 28, 0, 0, 30)
    rows = [event(anonymous_id=f"anon_{rng.randrange(3):07d}", session_id=f"sess_{rng.randrange(2)}", event_timestamp=start + dt.timedelta(seconds=rng.randrange(0, 40_000)),
                  ingested_at=start + dt.timedelta(hours=rng.randrange(60))) for _ in range(60)]
    raw, dest = scratch + "/raw", scratch + "/log"
    assert jobs.live_session_table(jobs.read_session_log(spark, dest)).count() == 0
    for part in (rows[40:], rows[:40]):
        io.write_raw(events_df(spark, part).drop("event_date"), raw, "events")
        jobs.session_log_stream(spark, raw, dest, scratch + "/ckpt", trigger=NOW).awaitTermination(300)
        whole = io.read_events(spark, raw)
        want = derived_sessions(whole, Config()).select("anonymous_id", "client_session_id", "distinct_client_session_ids", "session_start", "events")
        got = jobs.live_session_table(jobs.read_session_log(spark, dest))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 3


def test_dedup_job_keeps_one_copy_over_restarts_and_all_rows_without_an_id(spark, scratch):
    raw, dest = scratch + "/raw", scratch + "/once"
    copies = [event(event_id="evt_00000001"), event(event_id="evt_00000001", ingested_at="2026-07-30T12:00:01Z"), event(event_id="evt_00000002"), event(), event()]
    for part in (copies, copies[1:4]):
        io.write_raw(events_df(spark, part).drop("event_date"), raw, "events")
        jobs.dedup_stream(spark, raw, dest, scratch + "/ckpt", trigger=NOW).awaitTermination(300)
    ids = sorted(str(r.event_id) for r in io.read_events(spark, dest).collect())
    assert ids == ["None", "None", "None", "evt_00000001", "evt_00000002"]


def test_stream_of_events_reads_partly_readable_lines_and_no_compacted_ones(spark, scratch):
    wide = OK[:-1] + ',"device":{"screen_width":1280.0}}'
    _lines(scratch, "a", 28, [OK, wide, "no"])
    _lines(scratch, "compact-x", 28, [OK, wide])
    jobs.dedup_stream(spark, scratch, scratch + "/out", scratch + "/ckpt", trigger=NOW).awaitTermination(300)
    rows = io.read_events(spark, scratch + "/out").collect()
    assert sorted(str(r.device and r.device.screen_width) for r in rows) == ["1280", "None"]


def test_rows_beyond_the_horizon_are_counted(spark, scratch):
    def at(hours):
        return dt.datetime(2026, 7, 28) + dt.timedelta(hours=hours)

    batches = [[("v", "s", at(0)), ("v", "s", at(1))], [("v", "s", at(100))], [("v", "s", at(2)), ("v", "s", at(99))]]
    log = jobs.live_session_log(_stream(spark, scratch + "/rows", batches, "anonymous_id string, session_id string, event_timestamp timestamp"), horizon="24 hours")
    log.writeStream.outputMode("update").format("memory").queryName("horizon_log").trigger(availableNow=True).start().awaitTermination(300)
    log = spark.table("horizon_log")
    assert sorted((r.session_start, r.events) for r in jobs.live_session_table(log).collect()) == [(at(0), 1), (at(1), 1), (at(99), 1), (at(100), 1)]
    assert [(r.kind, r.events) for r in log.where("kind <> 'session'").collect()] == [("late", 1)]


def test_session_states_folded_in_any_order(spark, scratch):
    def page(path):
        return {"url": f"https://www.example.com{path}", "path": path, "title": None, "referrer": None}

    google = {"source": "google", "medium": "cpc", "campaign": "brand", "content": None, "term": None, "attribution": "last_touch"}
    days = {27: [event(event_timestamp="2026-07-27T23:50:00Z", ingested_at="2026-07-27T23:50:01Z", page=page("/first"))],
            28: [event(event_timestamp="2026-07-28T00:05:00Z", ingested_at="2026-07-28T00:05:01Z", campaign=google, page=page("/mid")), event(anonymous_id="anon_other_01")],
            29: [event(event_timestamp="2026-07-28T00:09:00Z", ingested_at="2026-07-29T00:00:01Z", page=page("/last"), params='{"gclid":"c"}')]}
    dest = scratch + "/states"
    assert read_sessions(spark, dest).count() == 0
    for day in (29, 27, 28, 27):
        fold_sessions(events_df(spark, days[day]), dest, [dt.date(2026, 7, day)])
    whole = sessions(events_df(spark, [r for rows in days.values() for r in rows]))
    assert sorted(map(str, read_sessions(spark, dest).collect())) == sorted(map(str, whole.collect()))


def test_a_run_can_be_removed(spark):
    kept = stored(spark.range(3).toDF("x"), "kept")
    assert kept.count() == 3 and layer.exists(spark, run_folder(spark))


def test_rows_of_a_batch_join_sessions_like_a_sort_of_all_rows():
    rng, minute = random.Random(5), 60_000_000
    for _ in range(200):
        sessions, all_rows, span = [], [], rng.choice((60, 600, 6000))
        for _ in range(3):
            rows = [(rng.randrange(-50 * minute, span * minute), rng.choice([None, "a", "b"])) for _ in range(rng.randrange(30))]
            before = {s[0] for s in sessions}
            touched = jobs._joined(sessions, rows, 30)
            want = []
            all_rows += rows
            for at, sid in sorted(all_rows, key=lambda r: r[0]):
                if not want or at // minute - want[-1][1] // minute >= 30:
                    want.append([at, at, 0, set()])
                want[-1][1], want[-1][2] = at, want[-1][2] + 1
                want[-1][3] |= {sid} - {None}
            assert sessions == [[a, b, n, sorted(ids)] for a, b, n, ids in want]
            # Only sessions that were logged before or are there now come into the log.
            now = {s[0] for s in sessions}
            assert before ^ now <= touched <= before | now


def test_landed_events_are_one_file_a_date_and_part(spark, scratch):
    pages = spark.range(3).selectExpr("id AS page_id", "concat('https://www.example.com/', id) AS url")
    events = spark.range(800).selectExpr("id AS event_id", "timestamp_seconds(1785000000 + id * 1000) AS ts", "id % 9 AS user_id", "'view' AS event_type", "0.0D AS value", "'{}' AS props")
    pages.write.parquet(scratch + "/pages.parquet")
    events.write.parquet(scratch + "/events.parquet")
    roots = []
    catalog._landed_twice(spark, scratch, roots.append)
    files = [f.rsplit("/", 1)[0] for f in spark.read.text(roots[0] + "/events").inputFiles()]
    assert len(files) == len(set(files)) > 10
    assert io.read_events(spark, roots[0]).count() == 840
