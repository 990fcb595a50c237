"""E8 rejected-by-dt report and H3 live sessions."""

import datetime as dt


from clickpath.operators import ingest as I
from clickpath.plans.reports import rejected_by_dt
from clickpath.streaming import jobs

NOW = dt.datetime(2026, 7, 28, 12, 0, 0)


def test_rejected_by_dt(spark):
    bodies = ['{"a": 1}', "{not json", '[1, "x"]', '{"b": 2}']
    p = I.ingest(spark.createDataFrame([(b, NOW) for b in bodies], "body string, received_at timestamp"))
    r = rejected_by_dt(I.bad_rows(p)).collect()
    assert len(r) == 1 and r[0].bad_rows == 5
    assert len(r[0].sample_errors) == 3 and r[0].sample_errors == sorted(r[0].sample_errors)


def test_live_sessions_split_at_gap(spark, scratch):
    t0 = dt.datetime(2026, 7, 28, 10, 0, 0)
    rows = [("A", t0 + dt.timedelta(seconds=s), "page_view") for s in (0, 60, 60 + 1800, 60 + 1800 + 1799)]
    rows.append(("B", t0 + dt.timedelta(days=1), "page_view"))   # moves the watermark past A
    src = scratch + "/ev"
    spark.createDataFrame(rows, "anonymous_id string, event_time timestamp, event_name string").write.parquet(src)
    stream = spark.readStream.schema("anonymous_id string, event_time timestamp, event_name string").parquet(src)
    q = (jobs.live_sessions(stream, lateness="0 seconds").writeStream.format("memory").queryName("live_sessions_out")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = sorted(r.events for r in spark.table("live_sessions_out").where("anonymous_id = 'A'").collect())
    assert got == [2, 2]     # exactly 30:00 apart opens a new session; 29:59 does not
