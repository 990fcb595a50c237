"""The derived layer as a whole: folds in any order (H5), snapshots (A5), empty and first reads (A1, A3)."""

import datetime as dt
import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from clickpath.operators.derived import derived_events, rebuild_derived
from clickpath.sources import io, layer
from clickpath.sources.schema import DERIVED_SCHEMA, EVENT_COLUMNS
from clickpath.streaming import jobs
from helpers import event, events_df

COLS = ["event_id", "anonymous_id", "event_timestamp", "ingested_at", "event_time", "event_date"]


def _at(day, hour=12, who="anon_0000001", **kw):
    return event(ingested_at=f"2026-01-{day:02d}T{hour:02d}:00:00Z", event_timestamp=f"2026-01-{day:02d}T{hour:02d}:00:00Z", anonymous_id=who, **kw)


def _write(spark, root, rows, batch):
    io.write_raw(events_df(spark, rows), root, "events", batch)


def _rows(df):
    return sorted(map(str, df.select(*COLS).collect()))


def _days():
    same = "evt_in_three_dates"
    return {3: [_at(3, who="anon_of_day_3", event_id=same), _at(3, event_id="evt_of_day_3"), _at(3, who="anon_noid_3a"), _at(3, who="anon_noid_3a")],
            4: [_at(4, who="anon_of_day_4", event_id=same), _at(4, 1, event_id="evt_twice_on_4"), _at(4, 2, event_id="evt_twice_on_4")],
            5: [_at(5, who="anon_of_day_5", event_id=same), _at(5, event_id="evt_of_day_5"), _at(5, who="anon_noid_5a"),
                event(event_id="evt_far_off_clock", ingested_at="2026-01-05T12:00:00Z", event_timestamp="2026-01-04T13:00:00Z")]}


@pytest.mark.parametrize("order,snapshots", [((5, 3, 4), False), ((4, 5, 3), True)])
def test_folds_in_any_order_equal_a_full_rebuild(spark, scratch, order, snapshots):
    """From an empty deployment on; late dates dethrone copies, and lost ones bring them back."""
    raw, dest, days = scratch + "/raw", scratch + "/derived", _days()
    assert io.read_events(spark, raw).count() == 0 and io.read_derived(spark, dest).count() == 0
    for day, rows in days.items():
        _write(spark, raw, rows, f"day-{day}")
    done = []
    for day in order:
        done.append(dt.date(2026, 1, day))
        jobs.incremental_rebuild(spark, raw, dest, [done[-1]], snapshots=snapshots)
        assert _rows(io.read_derived(spark, dest)) == _rows(derived_events(io.read_events(spark, raw).where(F.col("dt").isin(done))))
    assert [r.anonymous_id for r in io.read_derived(spark, dest).where("event_id = 'evt_in_three_dates'").collect()] == ["anon_of_day_3"]
    assert jobs.incremental_rebuild(spark, raw, dest, [done[0]]) == 0                 # nothing changed, nothing written
    # Day 3 is folded again without the earliest copy and with one nameless row less.
    _write(spark, raw, days[3][1:3], "day-3")
    jobs.incremental_rebuild(spark, raw, dest, ["2026-01-03"])
    back = io.read_derived(spark, dest)
    assert _rows(back) == _rows(derived_events(io.read_events(spark, raw)))
    assert [r.anonymous_id for r in back.where("event_id = 'evt_in_three_dates'").collect()] == ["anon_of_day_4"]
    if not snapshots:
        assert _rows(spark.read.parquet(dest)) == _rows(back)                        # plain Parquet for any reader
        shutil.rmtree(dest + "/_layer")
        with pytest.raises(ValueError):
            jobs.incremental_rebuild(spark, raw, dest, ["2026-01-03"])


def test_vanished_date_leaves_no_partition(spark, scratch):
    raw, dest = scratch + "/raw", scratch + "/derived"
    _write(spark, raw, [_at(3, event_id="evt_of_day_3")], "day-3")
    jobs.incremental_rebuild(spark, raw, dest, ["2026-01-03"])
    assert glob.glob(dest + "/event_date=*")
    shutil.rmtree(raw + "/events")
    jobs.incremental_rebuild(spark, raw, dest, ["2026-01-03"])
    assert not glob.glob(dest + "/event_date=*") and io.read_derived(spark, dest).count() == 0


def test_rebuild_that_dies_leaves_the_old_snapshot(spark, scratch):
    dest = scratch + "/derived"
    first = [_at(3, event_id="evt_of_day_3"), _at(3)]
    rebuild_derived(events_df(spark, first), dest, snapshots=True)
    want = _rows(io.read_derived(spark, dest))

    def broken(rows):
        yield from list(rows)[:1]
        raise RuntimeError("dies midway")

    dying = events_df(spark, first + [_at(4)] * 50).repartition(4)
    with pytest.raises(Exception, match="dies midway"):
        rebuild_derived(dying.mapInPandas(broken, dying.schema), dest)
    assert _rows(io.read_derived(spark, dest)) == want
    reader = io.read_derived(spark, dest)                       # opened before the next rebuild
    stats = rebuild_derived(events_df(spark, first[:1]), dest)    # stays a layer of snapshots
    assert stats["derived_events"] == 1 and stats["files"] == 1 and stats["bytes"] > 0
    assert _rows(reader) == want and io.read_derived(spark, dest).count() == 1
    assert layer.current(spark, dest).number == 2
    assert layer.clean(spark, dest, keep=1) == 2 and io.read_derived(spark, dest).count() == 1      # the old data and index; the dead job left nothing


def test_two_writers_cannot_commit_one_number(spark, scratch):
    dest = scratch + "/derived"
    os.makedirs(dest)
    was = layer.current(spark, dest)
    layer.commit(spark, dest, was, {}, {})
    with pytest.raises(Exception, match="exist"):
        layer.commit(spark, dest, was, {"2026-01-01": "x"}, {})
    assert layer.current(spark, dest).dates == {} and io.read_derived(spark, dest).schema == DERIVED_SCHEMA_READ


DERIVED_SCHEMA_READ = type(DERIVED_SCHEMA)([f for f in DERIVED_SCHEMA.fields if f.name != "_dt"])


def test_empty_rebuild_reads_back(spark, scratch):
    dest = scratch + "/derived"
    stats = rebuild_derived(events_df(spark, []), dest)
    assert (stats["raw_events"], stats["derived_events"], stats["files"]) == (0, 0, 0)
    back = io.read_derived(spark, dest)
    assert back.count() == 0 and set(EVENT_COLUMNS) <= set(back.columns)
