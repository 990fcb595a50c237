"""Zone map of the raw events (E18), and bucketed event tables for D2 and D4."""

import pytest
from pyspark.sql import functions as F

from clickpath.operators.derived import bucketed_derived, derived_events
from clickpath.operators.sessions import bucketed_sessions, sessions
from clickpath.sources import buckets, compaction, io, zones
from helpers import event, events_df

COLS = ["anonymous_id", "event_id", "event_timestamp", "ingested_at", "dt", "event_date"]


def _rows(df, cols=COLS):
    return sorted(map(str, df.select(*cols).collect()))


def _batch(spark, root, name, days, ingest):
    rows = [event(event_timestamp=f"2026-01-{d:02d}T10:00:00Z", ingested_at=f"2026-01-{ingest:02d}T12:00:00Z", anonymous_id=f"anon_{name}_{d}") for d in days]
    io.write_raw(events_df(spark, rows).coalesce(1), root, "events", name)


def _pruned(spark, root, lo, hi):
    found = zones.read_between(spark, root, lo, hi)
    full = io.read_events(spark, root).where(F.col("event_date").between(lo, hi))
    assert _rows(found) == _rows(full)
    return sorted(f.split("batch=")[1].split("/")[0] for f in found.inputFiles())


def test_zone_map_equals_the_full_scan_and_opens_no_file_outside(spark, tmp_path):
    root = str(tmp_path / "raw + more")
    assert zones.update_zones(spark, root) == 0 and zones.read_between(spark, root, "2026-01-01", "2026-01-31").count() == 0
    _batch(spark, root, "a-0", [2, 3], 3)
    _batch(spark, root, "a-1", [4, 5], 5)
    _batch(spark, root, "a-2", [3, 28], 5)                       # a clock that is far off
    assert _pruned(spark, root, "2026-01-04", "2026-01-05") == ["a-0", "a-1", "a-2"]         # nothing is known yet
    assert zones.update_zones(spark, root) == 3 and zones.update_zones(spark, root) == 0
    assert _pruned(spark, root, "2026-01-04", "2026-01-05") == ["a-1", "a-2"]
    assert _pruned(spark, root, "2026-01-02", "2026-01-02") == ["a-0"]
    assert _pruned(spark, root, "2026-02-01", "2026-02-02") == []
    _batch(spark, root, "a-3", [9], 9)                           # not in the map: read
    assert _pruned(spark, root, "2026-01-02", "2026-01-02") == ["a-0", "a-3"]
    _batch(spark, root, "a-3", [2, 2], 9)                        # written again, still not in the map
    assert zones.update_zones(spark, root) == 1
    assert _pruned(spark, root, "2026-01-09", "2026-01-09") == ["a-2"]      # its zone spans the day
    assert _pruned(spark, root, "2026-01-29", "2026-01-31") == []
    compaction.compact(spark, root)
    for lo, hi in (("2026-01-02", "2026-01-02"), ("2026-01-28", "2026-01-28")):
        _pruned(spark, root, lo, hi)
    zones.update_zones(spark, root)
    assert zones.zones(spark, root).agg(F.sum("rows")).first()[0] == io.read_events(spark, root).count() == 8


def test_lines_without_a_date_are_known_and_not_opened(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([("{\"event_name\": \"page_view\"}", "2026-01-03"), ("no json", "2026-01-04")], "value string, dt string") \
        .repartition(1).write.partitionBy("dt").text(f"{root}/events/batch=x-0")
    assert zones.update_zones(spark, root) == 2
    assert sorted((r.rows, r.first_date) for r in zones.zones(spark, root).collect()) == [(0, None), (1, None)]
    assert _pruned(spark, root, "2026-01-01", "2026-01-31") == []


def _crowd(spark):
    """A visitor and an id with a third of all rows each, NULL keys, repeated deliveries."""
    rows = []
    for k in range(120):
        who = "anon_hot_visitor" if k % 3 == 0 else f"anon_{k % 17:07d}"
        name = "evt_hot" if k % 3 == 1 else (None if k % 4 == 0 else f"evt_{k % 50}")
        rows.append(event(anonymous_id=who, session_id="s1" if k % 3 == 0 else f"s{k % 5}", event_id=name,
                          event_timestamp=f"2026-01-03T10:{k % 60:02d}:00Z", ingested_at=f"2026-01-03T12:{k % 60:02d}:{k // 60:02d}Z"))
    rows.append(event(anonymous_id=None, session_id=None))
    return events_df(spark, rows)


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan.count("Bucketed: true")


@pytest.mark.parametrize("by", [["anonymous_id", "session_id"], ["anonymous_id"]])
def test_sessions_over_buckets_move_no_rows(spark, tmp_path, by):
    events = _crowd(spark)
    buckets.write_bucketed(events, str(tmp_path), by, 4)
    table = buckets.read_bucketed(spark, str(tmp_path))
    assert {r.anonymous_id for r in table.apart.collect()} == {"anon_hot_visitor", None}
    assert _rows(bucketed_sessions(table), sessions(events).columns) == _rows(sessions(events), sessions(events).columns)
    assert _exchanges(sessions(table.rows)) == (0, 1)
    with pytest.raises(ValueError):
        bucketed_derived(table)


def test_dedup_over_buckets_moves_no_rows(spark, tmp_path):
    events, cols = _crowd(spark), ["event_id", "anonymous_id", "ingested_at", "event_time", "event_date"]
    buckets.write_bucketed(events, str(tmp_path), ["event_id"], 4)
    spark.sql(f"DROP TABLE {[t.name for t in spark.catalog.listTables() if t.name.startswith('clickpath_')][-1]}")     # as in a new session
    table = buckets.read_bucketed(spark, str(tmp_path))
    assert {r.event_id for r in table.apart.collect()} == {"evt_hot", None}
    assert _rows(bucketed_derived(table), cols) == _rows(derived_events(events), cols)
    assert _exchanges(derived_events(table.rows)) == (0, 1)
    with pytest.raises(ValueError):
        bucketed_sessions(table)


def test_empty_and_rewritten_bucketed_tables(spark, tmp_path):
    events, dest = _crowd(spark), str(tmp_path)
    buckets.write_bucketed(events.limit(0), dest, ["event_id"], 4)
    assert bucketed_derived(buckets.read_bucketed(spark, dest)).count() == 0
    buckets.write_bucketed(events, dest, ["event_id"], 3)
    assert bucketed_derived(buckets.read_bucketed(spark, dest)).count() == derived_events(events).count()
