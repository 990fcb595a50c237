"""Sessions (D2), gap sessions (D3): boundary, NULL-skipping and skew-layout invariance."""

from pyspark.sql import functions as F

from clickpath.config import Config
from clickpath.operators.sessions import derived_sessions, gap_session_numbers, sessions
from clickpath.sources.bridge import BRIDGE_CONFIG, bridge_events
from helpers import event, events_df


def _gap_counts(spark, mode):
    rows = [
        event(anonymous_id="A", event_timestamp="2026-07-28T10:00:00Z"),
        event(anonymous_id="A", event_timestamp="2026-07-28T10:30:00Z"),        # exactly 30:00
        event(anonymous_id="B", event_timestamp="2026-07-28T10:00:00Z"),
        event(anonymous_id="B", event_timestamp="2026-07-28T10:29:59.900000Z"),  # 29:59.9
        event(anonymous_id="C", event_timestamp="2026-07-28T10:00:59Z"),
        event(anonymous_id="C", event_timestamp="2026-07-28T10:30:01Z"),        # 29:02, 30 boundaries
        event(anonymous_id="D", event_timestamp="2026-07-28T23:50:00Z"),
        event(anonymous_id="D", event_timestamp="2026-07-29T00:10:00Z"),        # across midnight
    ]
    n = gap_session_numbers(events_df(spark, rows), Config(chunks=3), mode=mode)
    return {r.anonymous_id: r.n for r in n.groupBy("anonymous_id")
            .agg(F.max("derived_session_number").alias("n")).collect()}


def test_gap_boundary_rule(spark):
    assert _gap_counts(spark, "boundary") == {"A": 2, "B": 1, "C": 2, "D": 1}


def test_gap_elapsed_rule(spark):
    assert _gap_counts(spark, "elapsed") == {"A": 2, "B": 1, "C": 1, "D": 1}


def test_first_non_null_campaign_attributes_session(spark):
    rows = [
        event(event_timestamp="2026-07-28T10:00:00Z", page={"url": "https://www.example.com/a", "path": "/a",
                                                             "title": None, "referrer": None}),
        event(event_timestamp="2026-07-28T10:01:00Z",
              campaign={"source": "google", "medium": "cpc", "campaign": "brand", "content": None, "term": None,
                        "attribution": "last_touch"}),
        event(event_timestamp="2026-07-28T10:02:00Z", event_name="click",
              page={"url": "https://www.example.com/z", "path": "/z", "title": None, "referrer": None}),
    ]
    s = sessions(events_df(spark, rows)).collect()
    assert len(s) == 1
    r = s[0]
    assert (r.source, r.medium, r.campaign_name, r.channel) == ("google", "cpc", "brand", "Paid Search")
    assert (r.entry_path, r.exit_path, r.events, r.page_views, r.duration_seconds) == ("/a", "/z", 3, 2, 120)


def test_backdated_event_client_vs_trusted_clock(spark):
    rows = [
        event(event_timestamp="2026-07-28T10:00:00Z", ingested_at="2026-07-28T10:00:01Z",
              campaign={"source": "google", "medium": "organic", "campaign": None, "content": None, "term": None,
                        "attribution": "last_touch"}),
        event(event_timestamp="2026-02-01T00:00:00Z", ingested_at="2026-07-28T10:05:00Z",
              campaign={"source": "evil", "medium": "cpc", "campaign": "x", "content": None, "term": None,
                        "attribution": "last_touch"}),
    ]
    from clickpath.operators.derived import derived_events
    df = events_df(spark, rows)
    client = sessions(df).first()
    trusted = sessions(derived_events(df), time_col="event_time").first()
    assert client.source == "evil"          # the client clock lets a backdated event attribute
    assert trusted.source == "google" and trusted.channel == "Organic Search"


def test_chunk_size_does_not_change_results(spark):
    ev = bridge_events(spark, "/root/testdata/sf0.001")
    a = derived_sessions(ev, Config(internal_domains=BRIDGE_CONFIG.internal_domains, chunks=13))
    b = derived_sessions(ev, Config(internal_domains=BRIDGE_CONFIG.internal_domains, chunks=1))
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_session_key_is_pair(spark):
    rows = [event(anonymous_id="A", session_id="1785240000"), event(anonymous_id="B", session_id="1785240000")]
    assert sessions(events_df(spark, rows)).count() == 2


def test_hot_visitor_at_one_timestamp_is_spread(spark):
    """One visitor, 200,000 rows, one timestamp: chunks are cut by rows and numbers do not change."""
    from clickpath.operators import sequence

    one = spark.range(200_000).select(F.lit("bot").alias("who"), F.timestamp_seconds(F.lit(1_700_000_000)).alias("ts"), "id")
    more = one.unionAll(spark.range(5).select(F.lit(None).cast("string"), F.lit(None).cast("timestamp"), "id"))
    cut = sequence._chunked(more, "who", [F.col("ts").asc_nulls_last(), F.col("id"), F.col(sequence.ROW)], 8)
    sizes = [r["count"] for r in cut.groupBy(sequence.CHUNK).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 60_000
    gap = lambda a, b: F.coalesce(F.unix_seconds(b) - F.unix_seconds(a) >= 1800, F.lit(True))
    n = sequence.number_sessions(more, "who", "ts", gap, ["id"], chunks=8).groupBy("who").agg(F.max("session_number").alias("n"), F.count("*").alias("c"))
    assert {(r.who, r.n, r.c) for r in n.collect()} == {("bot", 1, 200_000), (None, 5, 5)}


def test_scan_kinds_equal_windows(spark):
    from pyspark.sql import Window

    from clickpath.operators import sequence

    rows = spark.range(300).select((F.col("id") % 3).cast("string").alias("k"), F.when(F.col("id") % 17 != 0, F.timestamp_seconds((F.col("id") * 7919) % 5000)).alias("ts"),
                                   "id", F.when(F.col("id") % 4 == 0, F.col("id")).alias("v"))
    w = Window.partitionBy("k").orderBy(F.col("ts").asc_nulls_last(), "id")
    want = rows.select("k", "id", F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("l"), F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("b"),
                       F.lag("id").over(w).alias("p"), F.first("id").over(w).alias("f"), (F.row_number().over(w) == 1).alias("is_first"))
    v, i = F.col("v"), F.col("id")
    for chunks in (1, 7):
        got = sequence.scan(rows, "k", "ts", {"l": ("last", v), "b": ("before", v), "p": ("prev", i), "f": ("first", i)}, ["id"], chunks=chunks)
        assert sorted(map(str, got.select("k", "id", "l", "b", "p", "f", "is_first").collect())) == sorted(map(str, want.collect()))
