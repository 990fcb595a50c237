"""Derived layer (D4, A5, E17): the reference's destruction-risk cases."""

import datetime as dt

from pyspark.sql import functions as F

from clickpath.operators.derived import derived_events, rebuild_derived
from clickpath.sources.schema import EVENT_COLUMNS
from helpers import event, events_df


def _rows():
    return [
        event(event_id="dup_0000000001", ingested_at="2026-07-28T12:00:01Z", anonymous_id="anon_dup_first"),
        event(event_id="dup_0000000001", ingested_at="2026-07-28T12:00:09Z", anonymous_id="anon_dup_second"),
        event(anonymous_id="anon_noid_0001"),
        event(anonymous_id="anon_noid_0002"),
        event(event_id="trust_000000001", event_timestamp="2026-07-27T23:00:00Z",
              ingested_at="2026-07-27T23:00:02Z", anonymous_id="anon_trusted01"),
        event(event_id="skewed_00000001", event_timestamp="2026-02-11T19:20:04Z",
              ingested_at="2026-07-28T12:00:03Z", anonymous_id="anon_skewed001"),
    ]


def test_dedup_and_clock(spark):
    d = {r.anonymous_id: r for r in derived_events(events_df(spark, _rows())).collect()}
    assert len(d) == 5
    assert "anon_dup_first" in d and "anon_dup_second" not in d
    assert "anon_noid_0001" in d and "anon_noid_0002" in d
    t = d["anon_trusted01"]
    assert t.event_time_trusted and t.event_date == dt.date(2026, 7, 27)
    s = d["anon_skewed001"]
    assert not s.event_time_trusted and s.event_date == dt.date(2026, 7, 28)
    assert s.event_timestamp == dt.datetime(2026, 2, 11, 19, 20, 4)
    assert round(s.skew_seconds / 86400, 2) == -166.69


def test_rebuild_is_idempotent(spark, scratch):
    raw = events_df(spark, _rows())
    dest = scratch + "/derived"
    stats = [rebuild_derived(raw, dest) for _ in range(3)]
    assert all(s["derived_events"] == 5 and s["raw_events"] == 6 and s["duplicates_removed"] == 1 for s in stats)
    assert stats[0]["untrusted_clock"] == 1 and stats[0]["partitions"] == 2
    back = spark.read.parquet(dest)
    assert back.count() == 5
    assert sorted(r.event_date for r in back.select("event_date").distinct().collect()) == \
        [dt.date(2026, 7, 27), dt.date(2026, 7, 28)]
    assert set(EVENT_COLUMNS) <= set(back.columns)


def test_one_scan_and_no_window(spark, scratch):
    events_df(spark, _rows()).write.parquet(scratch + "/raw")
    plan = derived_events(spark.read.parquet(scratch + "/raw"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Window" not in plan


def test_equal_rows_without_an_id_all_stay(spark):
    rows = [event(anonymous_id="anon_same_0001")] * 3 + [event(event_id="same_000000001")] * 3
    assert derived_events(events_df(spark, rows)).count() == 4
