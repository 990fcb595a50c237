"""Registered queries: name -> (Spark builder over (spark, sf_dir), DuckDB oracle SQL).

Every query reads the driver's tables through the bridge (``contract_events``), so its
work grows with them.  Column names are aliased identically on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath.functions import channels as C
from clickpath.operators import health as H
from clickpath.operators.derived import bucketed_derived, derived_events, rebuild_derived, rebuild_stats
from clickpath.operators.sessions import bucketed_sessions, derived_sessions, fold_sessions, read_sessions, sessions
from clickpath.plans import oracle as O
from clickpath.plans import reports as R
from clickpath.operators import ingest as I
from clickpath.operators import journeys as J
from clickpath.operators.contract import V0
from clickpath.plans import oracle_ingest as OI
from clickpath.shipping import ship_package
from clickpath.sources import buckets, compaction, io, zones
from clickpath.sources.bodies import bridge_access_log, bridge_bodies, bridge_requests
from clickpath.storage import run_folder, stored, unstored
from clickpath.streaming.jobs import dedup_stream, incremental_rebuild, ingest_stream, live_quality, live_session_table, read_session_log, session_log_stream
from clickpath.sources.bridge import BRIDGE_CONFIG, bridge_events, bridge_hits

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ---- shared inputs -----------------------------------------------------------------------
def ev(spark, sf):
    return bridge_events(spark, sf)


def ses(spark, sf):
    return sessions(ev(spark, sf), BRIDGE_CONFIG)


def flat(df: DataFrame) -> DataFrame:
    """Struct columns flattened to ``<struct>_<field>`` for comparison."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "struct":
            cols += [F.col(f"{f.name}.{g.name}").alias(f"{f.name}_{g.name}") for g in f.dataType.fields]
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


FLAT_SQL = ("* EXCLUDE (page, campaign, device), "
            "page.url AS page_url, page.path AS page_path, page.title AS page_title, "
            "page.referrer AS page_referrer, campaign.source AS campaign_source, "
            "campaign.medium AS campaign_medium, campaign.campaign AS campaign_campaign, "
            "campaign.content AS campaign_content, campaign.term AS campaign_term, "
            "campaign.attribution AS campaign_attribution, device.platform AS device_platform, "
            "device.user_agent AS device_user_agent, device.language AS device_language, "
            "device.screen_width AS device_screen_width, device.screen_height AS device_screen_height")

S = O.sessions_cte()
DS = O.derived_sessions_cte()
DE = O.derived_events_cte()


# ---- D1 / A1: the events view ------------------------------------------------------------
@register("events_view", O.with_ctes(select=f"SELECT {FLAT_SQL} FROM contract_events"))
def q_events_view(spark, sf):
    return flat(ev(spark, sf))


# ---- D2 / D3 / D4 --------------------------------------------------------------------------
@register("sessions", O.with_ctes(S, select="SELECT * FROM sessions"))
def q_sessions(spark, sf):
    return ses(spark, sf)


@register("derived_sessions", O.with_ctes(DS, select="SELECT * FROM derived_sessions"))
def q_derived_sessions(spark, sf):
    return derived_sessions(ev(spark, sf), BRIDGE_CONFIG)


@register("derived_events", O.with_ctes(DE, select=f"SELECT {FLAT_SQL} FROM derived_events"))
def q_derived_events(spark, sf):
    return flat(derived_events(ev(spark, sf), BRIDGE_CONFIG))


# ---- health views D6-D12 -------------------------------------------------------------------
SKEW_SQL = (f"SELECT {O.skew_bucket_sql('skew')} AS bucket, count(*) AS events, "
            f"{O.round_half_away('min(skew) / 86400.0', 2)} AS min_days, "
            f"{O.round_half_away('max(skew) / 86400.0', 2)} AS max_days "
            "FROM (SELECT epoch(event_timestamp) - epoch(ingested_at) AS skew FROM contract_events) GROUP BY 1")


@register("health_clock_skew", O.with_ctes(select=SKEW_SQL))
def q_health_clock_skew(spark, sf):
    return H.health_clock_skew(ev(spark, sf))


EVENT_ID_SQL = (
    "SELECT events, with_event_id, "
    f"{O.round_half_away('100.0 * with_event_id / nullif(events, 0)', 1)} AS coverage_pct, "
    "with_event_id - n_distinct AS duplicate_deliveries, "
    f"{O.round_half_away('100.0 * (with_event_id - n_distinct) / nullif(with_event_id, 0)', 2)} "
    "AS duplicate_pct_of_covered "
    "FROM (SELECT count(*) AS events, count(event_id) AS with_event_id, "
    "count(DISTINCT event_id) AS n_distinct FROM contract_events)")


@register("health_event_id", O.with_ctes(select=EVENT_ID_SQL))
def q_health_event_id(spark, sf):
    return H.health_event_id(ev(spark, sf))


TAGGING_SQL = ("SELECT channel, coalesce(source, '(direct)') AS source, "
               "coalesce(campaign_name, '(not set)') AS campaign, count(*) AS sessions FROM sessions "
               "WHERE campaign_name IS NOT NULL AND (medium IS NULL OR medium = '') GROUP BY 1, 2, 3")


@register("health_tagging", O.with_ctes(S, select=TAGGING_SQL))
def q_health_tagging(spark, sf):
    return H.health_tagging(ses(spark, sf))


ROBOTIC_SQL = (
    "SELECT entry_path, sessions, single_hit_sessions, "
    f"{O.round_half_away('100.0 * single_hit_sessions / sessions', 1)} AS single_hit_pct, visitors "
    "FROM (SELECT entry_path, count(*) AS sessions, count(*) FILTER (WHERE page_views = 1) AS single_hit_sessions, "
    "count(DISTINCT anonymous_id) AS visitors FROM sessions WHERE entry_path IS NOT NULL GROUP BY 1) "
    f"WHERE sessions >= {H.ROBOTIC_MIN_SESSIONS} "
    f"AND 100.0 * single_hit_sessions / sessions >= {H.ROBOTIC_MIN_SINGLE_HIT_PCT}")


@register("health_robotic_paths", O.with_ctes(S, select=ROBOTIC_SQL))
def q_health_robotic_paths(spark, sf):
    return H.health_robotic_paths(ses(spark, sf))


def _hosts_sql(where: str) -> str:
    return ("SELECT entry_hostname, count(*) AS sessions, count(DISTINCT anonymous_id) AS visitors "
            f"FROM sessions WHERE {where} GROUP BY 1")


SCANNER_SQL = _hosts_sql(f"entry_hostname IN ({', '.join(repr(h) for h in C.SCANNER_HOSTS)})")
NONPROD_SQL = _hosts_sql(f"regexp_matches(coalesce(entry_hostname, ''), '{H.NONPROD_HOST_PATTERN}')")
PREVIEW_SQL = ("SELECT coalesce(source, '(direct)') AS source, coalesce(medium, '(none)') AS medium, "
               "count(*) AS sessions FROM sessions WHERE contains(lower(coalesce(source, '')), 'preview') "
               f"OR lower(coalesce(medium, '')) IN ({', '.join(repr(m) for m in H.PREVIEW_MEDIUMS)}) "
               "GROUP BY 1, 2")


@register("health_scanner_traffic", O.with_ctes(S, select=SCANNER_SQL))
def q_health_scanner(spark, sf):
    return H.health_scanner_traffic(ses(spark, sf))


@register("health_nonprod_hostnames", O.with_ctes(S, select=NONPROD_SQL))
def q_health_nonprod(spark, sf):
    return H.health_nonprod_hostnames(ses(spark, sf))


@register("health_preview_traffic", O.with_ctes(S, select=PREVIEW_SQL))
def q_health_preview(spark, sf):
    return H.health_preview_traffic(ses(spark, sf))


# ---- reports E1-E18 -------------------------------------------------------------------------
@register("report_volume", O.with_ctes(select=(
    "SELECT count(*) AS events, count(DISTINCT anonymous_id) AS visitors, "
    "count(DISTINCT {'a': anonymous_id, 's': session_id}) AS sessions, "
    "min(event_timestamp) AS first_event, max(event_timestamp) AS last_event FROM contract_events")))
def q_volume(spark, sf):
    return R.volume(ev(spark, sf))


@register("report_ingest_vs_event_date", O.with_ctes(select=(
    "SELECT dt AS ingest_partition, event_date, count(*) AS events FROM contract_events "
    "GROUP BY 1, 2 ORDER BY 1, 2")))
def q_ingest_vs_event_date(spark, sf):
    return R.ingest_vs_event_date(ev(spark, sf))


SBC_SQL = ("SELECT channel, count(*) AS sessions, CAST(sum(page_views) AS BIGINT) AS page_views, "
           f"{O.round_half_away('avg(duration_seconds)', 1)} AS avg_seconds "
           "FROM sessions GROUP BY 1 ORDER BY sessions DESC, channel")


@register("report_sessions_by_channel", O.with_ctes(S, select=SBC_SQL))
def q_sessions_by_channel(spark, sf):
    return R.sessions_by_channel(ses(spark, sf))


@register("report_acquisition", O.with_ctes(S, select=(
    "SELECT channel, coalesce(source, '(direct)') AS source, coalesce(medium, '(none)') AS medium, "
    "coalesce(campaign_name, '(not set)') AS campaign, count(*) AS sessions FROM sessions GROUP BY 1, 2, 3, 4")))
def q_acquisition(spark, sf):
    return R.acquisition(ses(spark, sf))


@register("report_entry_pages", O.with_ctes(S, select=(
    "SELECT entry_path, count(*) AS sessions, CAST(sum(page_views) AS BIGINT) AS page_views FROM sessions "
    "WHERE entry_path IS NOT NULL GROUP BY 1 ORDER BY sessions DESC, entry_path LIMIT 10")))
def q_entry_pages(spark, sf):
    return R.entry_pages(ses(spark, sf))


@register("report_events_by_name", O.with_ctes(select=(
    "SELECT event_name, count(*) AS events, count(DISTINCT anonymous_id) AS visitors "
    "FROM contract_events GROUP BY 1 ORDER BY events DESC")))
def q_events_by_name(spark, sf):
    return R.events_by_name(ev(spark, sf))


@register("report_client_vs_gap_sessions", O.with_ctes(S, DS, select=(
    "SELECT c AS client_assigned, g AS derived_from_gap, c - g AS difference FROM "
    "(SELECT count(DISTINCT (anonymous_id, session_id)) AS c FROM contract_events), "
    "(SELECT CAST(sum(top) AS BIGINT) AS g FROM (SELECT max(derived_session_number) AS top FROM derived_sessions GROUP BY anonymous_id))")))
def q_client_vs_gap(spark, sf):
    e = stored(ev(spark, sf).select("anonymous_id", "session_id", "ingested_at", "event_id", "event_timestamp"), "session-keys")
    return R.client_vs_gap_sessions(e.select("anonymous_id", "session_id").distinct(), derived_sessions(e, BRIDGE_CONFIG))


@register("report_clock_skew", O.with_ctes(select=SKEW_SQL + " ORDER BY events DESC, bucket"))
def q_report_clock_skew(spark, sf):
    return R.clock_skew_report(H.health_clock_skew(ev(spark, sf)))


@register("report_event_id", O.with_ctes(select=EVENT_ID_SQL))
def q_report_event_id(spark, sf):
    return H.health_event_id(ev(spark, sf))


@register("report_tagging_top10", O.with_ctes(S, select=(
    f"SELECT * FROM ({TAGGING_SQL}) ORDER BY sessions DESC, channel, source, campaign LIMIT 10")))
def q_tagging_top(spark, sf):
    return R.tagging_report(H.health_tagging(ses(spark, sf)))


@register("report_attribution_provenance", O.with_ctes(S, select=(
    f"SELECT attribution_from, n AS sessions, {O.round_half_away('100.0 * n / whole', 1)} AS pct "
    "FROM (SELECT attribution_from, count(*) AS n FROM sessions GROUP BY ALL), (SELECT count(*) AS whole FROM sessions)")))
def q_provenance(spark, sf):
    return R.attribution_provenance(ses(spark, sf))


@register("report_robotic_top10", O.with_ctes(S, select=(
    f"SELECT * FROM ({ROBOTIC_SQL}) ORDER BY sessions DESC, entry_path LIMIT 10")))
def q_robotic_top(spark, sf):
    return R.robotic_report(H.health_robotic_paths(ses(spark, sf)))


@register("report_scanner_traffic", O.with_ctes(S, select=SCANNER_SQL + " ORDER BY sessions DESC"))
def q_report_scanner(spark, sf):
    return R.by_sessions_desc(H.health_scanner_traffic(ses(spark, sf)), "entry_hostname")


@register("report_nonprod_hostnames", O.with_ctes(S, select=NONPROD_SQL + " ORDER BY sessions DESC"))
def q_report_nonprod(spark, sf):
    return R.by_sessions_desc(H.health_nonprod_hostnames(ses(spark, sf)), "entry_hostname")


@register("report_preview_traffic", O.with_ctes(S, select=PREVIEW_SQL + " ORDER BY sessions DESC"))
def q_report_preview(spark, sf):
    return R.by_sessions_desc(H.health_preview_traffic(ses(spark, sf)), "source", "medium")


@register("report_rebuild_stats", O.with_ctes(DE, select=(
    "SELECT r.raw_events, d.derived_events, r.raw_events - d.derived_events AS duplicates_removed, "
    "d.untrusted_clock, d.partitions FROM (SELECT count(*) AS raw_events FROM contract_events) r, "
    "(SELECT count(*) AS derived_events, count(*) FILTER (WHERE NOT event_time_trusted) AS untrusted_clock, "
    "count(DISTINCT event_date) AS partitions FROM derived_events) d")))
def q_rebuild_stats(spark, sf):
    return rebuild_stats(ev(spark, sf), BRIDGE_CONFIG)


@register("report_dt_vs_event_date", O.with_ctes(select=(
    "SELECT event_date, count(*) AS events, count(*) FILTER (WHERE dt = event_date) AS same_dt_events, "
    "count(*) FILTER (WHERE dt >= event_date - INTERVAL 1 DAY AND dt <= event_date + INTERVAL 1 DAY) "
    "AS padded_dt_events, "
    f"{O.round_half_away('100.0 * count(*) FILTER (WHERE dt >= event_date - INTERVAL 1 DAY AND dt <= event_date + INTERVAL 1 DAY) / count(*)', 2)} "
    "AS padded_capture_pct FROM contract_events GROUP BY 1")))
def q_dt_vs_event_date(spark, sf):
    return R.dt_vs_event_date(ev(spark, sf))


# ---- journeys F1-F10 ------------------------------------------------------------------------
JR = O.journey_cte()


def jr(spark, sf):
    return J.journey_events(bridge_hits(spark, sf), BRIDGE_CONFIG)


@register("journey_events", O.with_ctes(JR, select="SELECT * FROM journey"))
def q_journey_events(spark, sf):
    return jr(spark, sf)


@register("journey_derived_rows", O.with_ctes(JR, select=(
    "SELECT anonymous_id, session_id, event_id, ts, page_path, attribution, 'session_start' AS event_name "
    "FROM journey WHERE is_session_start UNION ALL "
    "SELECT anonymous_id, session_id, event_id, ts, page_path, attribution, 'first_visit' AS event_name "
    "FROM journey WHERE is_first_visit")))
def q_journey_derived_rows(spark, sf):
    return J.journey_derived_rows(jr(spark, sf))


@register("journey_sessions", O.with_ctes(JR, select=(
    "SELECT anonymous_id, session_id, min(ts) AS session_start, max(ts) AS session_end, "
    "count(*) AS events, count(*) FILTER (WHERE event_name = 'page_view') AS page_views, "
    "arg_min(page_path, (ts, event_id)) AS entry_path, arg_max(page_path, (ts, event_id)) AS exit_path "
    "FROM journey GROUP BY 1, 2")))
def q_journey_sessions(spark, sf):
    return J.journey_sessions(jr(spark, sf))


# ---- ingest B1-B8 -----------------------------------------------------------------------------
IG = OI.ingest_ctes()


def processed(spark, sf):
    ship_package(spark)                    # the redaction UDF runs on the workers
    return I.ingest(bridge_bodies(spark, sf))


@register("ingest_fork_counts", O.with_ctes(IG, select=OI.FORK_COUNTS))
def q_ingest_fork_counts(spark, sf):
    return I.fork_counts(processed(spark, sf))


@register("ingest_errors", O.with_ctes(IG, select=OI.ERRORS))
def q_ingest_errors(spark, sf):
    return (processed(spark, sf).select(F.explode("errors").alias("error"))
            .groupBy("error").agg(F.count(F.lit(1)).alias("elements")))


@register("ingest_bad_rows", O.with_ctes(IG, select=OI.BAD_ROWS))
def q_ingest_bad_rows(spark, sf):
    return I.bad_rows(processed(spark, sf)).select(
        "ingested_at", "dt", F.array_join("errors", " | ").alias("errors_text"), "payload", "payload_raw")


@register("ingest_good_events", O.with_ctes(IG, select=OI.GOOD_EVENTS))
def q_ingest_good_events(spark, sf):
    g = I.good_events(processed(spark, sf))
    return flat(g)


def scratch(spark) -> str:
    """A folder of its own for a query that writes and reads back."""
    return f"{run_folder(spark)}/clickpath-query-{uuid.uuid4().hex}"


# ---- sinks and sources, written and read back (A1-A5, D5) -------------------------------------
@register("raw_events_round_trip", O.with_ctes(select=f"SELECT {FLAT_SQL} FROM contract_events"))
def q_raw_round_trip(spark, sf):
    root, e = scratch(spark), ev(spark, sf)
    io.write_raw(e.where(F.pmod(F.xxhash64("anonymous_id"), F.lit(2)) == 0), root, "events")
    io.write_raw(e.where(F.pmod(F.xxhash64("anonymous_id"), F.lit(2)) != 0), root, "events", "stream-0")
    return flat(io.read_events(spark, root))


@register("bad_rows_round_trip", O.with_ctes(IG, select=OI.BAD_ROWS))
def q_bad_round_trip(spark, sf):
    root = scratch(spark)
    io.write_raw(I.bad_rows(processed(spark, sf)), root, "bad")
    return io.read_bad(spark, root).select("ingested_at", "dt", F.array_join("errors", " | ").alias("errors_text"), "payload", "payload_raw")


@register("derived_round_trip", O.with_ctes(DE, select=f"SELECT * EXCLUDE (dt) FROM (SELECT {FLAT_SQL} FROM derived_events)"))
def q_derived_round_trip(spark, sf):
    root = scratch(spark)
    rebuild_derived(ev(spark, sf), root, BRIDGE_CONFIG)
    return flat(io.read_derived(spark, root))


def _thirds(events: DataFrame) -> list[list]:
    """The ingest dates of ``events`` in three runs, the last run first and the first one last."""
    dts = sorted((r["dt"] for r in events.select("dt").distinct().collect()), key=str)
    cut = -(-len(dts) // 3) or 1
    return [dts[2 * cut:], dts[cut:2 * cut], dts[:cut]]


@register("derived_folded_out_of_order", O.with_ctes(DE, select=f"SELECT * EXCLUDE (dt) FROM (SELECT {FLAT_SQL} FROM derived_events)"))
def q_derived_folded(spark, sf):
    """H5: the layer after folding the ingest dates in three steps, latest dates first, from nothing."""
    root, raw, e = scratch(spark), scratch(spark), ev(spark, sf)
    io.write_raw(e, raw, "events")
    for dts in _thirds(e):
        if dts:
            incremental_rebuild(spark, raw, root, dts, BRIDGE_CONFIG, snapshots=True)
    return flat(io.read_derived(spark, root))


@register("sessions_folded_out_of_order", O.with_ctes(S, select="SELECT * FROM sessions"))
def q_sessions_folded(spark, sf):
    """D2 merged from the states of three runs of ingest dates, each read once."""
    root, e = scratch(spark), stored(ev(spark, sf), "events")
    for dts in _thirds(e):
        if dts:
            fold_sessions(e.where(F.col("dt").isin(dts)), root, dts)
    return read_sessions(spark, root, BRIDGE_CONFIG)


@register("raw_events_compacted", O.with_ctes(select=f"SELECT {FLAT_SQL} FROM contract_events"))
def q_raw_compacted(spark, sf):
    """A4: the raw stream written in several small batches, read back after compaction."""
    root, e = scratch(spark), ev(spark, sf)
    for k in range(3):
        io.write_raw(e.where(F.pmod(F.xxhash64("anonymous_id"), F.lit(3)) == k), root, "events")
    compaction.compact(spark, root)
    return flat(io.read_events(spark, root))


def _bucketed(spark, sf, by: list[str]) -> buckets.Bucketed:
    dest = scratch(spark)
    buckets.write_bucketed(stored(ev(spark, sf), "events"), dest, by, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return buckets.read_bucketed(spark, dest)


@register("sessions_bucketed", O.with_ctes(S, select="SELECT * FROM sessions"))
def q_sessions_bucketed(spark, sf):
    """D2 over events bucketed by visitor and session."""
    return bucketed_sessions(_bucketed(spark, sf, ["anonymous_id", "session_id"]), BRIDGE_CONFIG)


@register("derived_events_bucketed", O.with_ctes(DE, select=f"SELECT {FLAT_SQL} FROM derived_events"))
def q_derived_bucketed(spark, sf):
    """D4 over events bucketed by id."""
    return flat(bucketed_derived(_bucketed(spark, sf, ["event_id"]), BRIDGE_CONFIG))


def _zoned(spark, sf) -> str:
    root = scratch(spark)
    io.write_raw(ev(spark, sf), root, "events")
    zones.update_zones(spark, root)
    return root


@register("zones_by_ingest_date", O.with_ctes(select=(
    "SELECT dt, count(*) AS events, min(event_date) AS first_date, max(event_date) AS last_date FROM contract_events GROUP BY 1")))
def q_zones(spark, sf):
    """The event dates that lie under each ingest date, from the zone map alone."""
    return zones.zones(spark, _zoned(spark, sf)).groupBy("dt").agg(
        F.sum("rows").alias("events"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))


@register("report_latest_event_dates", O.with_ctes(select=(
    "SELECT event_date, count(*) AS events, count(DISTINCT dt) AS ingest_dates FROM contract_events, "
    "(SELECT max(event_date) AS top FROM contract_events) WHERE event_date BETWEEN top - 29 AND top GROUP BY 1")))
def q_latest_event_dates(spark, sf):
    """Events of the latest 30 event dates, of which the zone map also tells the last."""
    root = _zoned(spark, sf)
    top = zones.zones(spark, root).agg(F.max("last_date").alias("last")).select(F.date_sub("last", 29).alias("first"), "last").first()
    found = zones.read_between(spark, root, top["first"], top["last"])
    return found.groupBy("event_date").agg(F.count(F.lit(1)).alias("events"), F.count_distinct("dt").alias("ingest_dates"))


@register("report_rebuild_job")
def q_rebuild_job(spark, sf):
    """E17 with files and bytes: what a rebuild into a new folder reports."""
    stats = rebuild_derived(ev(spark, sf), scratch(spark), BRIDGE_CONFIG)
    return spark.createDataFrame([tuple(stats.values())], ", ".join(f"{k} long" for k in stats))


@register("ingest_access_log_counts", O.with_ctes(IG.replace("    FROM corpus\n)", "    FROM corpus WHERE pixel\n)"), select=OI.FORK_COUNTS))
def q_access_log_counts(spark, sf):
    """Accepted and rejected pixel requests of a web server's access log."""
    ship_package(spark)
    return I.fork_counts(I.ingest(I.decode_pixel(I.log_pixels(bridge_access_log(spark, sf)))))


# ---- B9, and the streaming jobs H1 to H3 run to the end of what has landed ---------------------
#: A later version of the contract: the same rules under the next version's name.
V1 = replace(V0, field_rules=[(path, kinds, {"const": "1"} if path == "schema_version" else checks) for path, kinds, checks in V0.field_rules])
_KEY_TIME = "timezone('UTC', CAST(json_extract_string(elem, '$.event_timestamp') AS TIMESTAMPTZ))"


@register("ingest_replayed", O.with_ctes(IG, select=OI.GOOD_EVENTS.replace("FROM processed WHERE len(errors) = 0", (
    "FROM processed p WHERE array_to_string(errors, ' | ') = 'schema_version: ''0'' was expected' AND json_extract_string(elem, '$.schema_version') = '1' "
    "AND NOT EXISTS (SELECT 1 FROM (" + OI.GOOD_EVENTS + ") g WHERE g.event_id = json_extract_string(p.elem, '$.event_id') OR "
    "(g.event_id IS NULL AND json_extract_string(p.elem, '$.event_id') IS NULL AND g.ingested_at = p.ingested_at "
    "AND g.anonymous_id = json_extract_string(p.elem, '$.anonymous_id') AND g.session_id = json_extract_string(p.elem, '$.session_id') "
    f"AND g.event_name = json_extract_string(p.elem, '$.event_name') AND g.event_timestamp = {_KEY_TIME.replace('elem', 'p.elem')}))"))))
def q_replayed(spark, sf):
    """Stored bad rows judged again once the contract's next version is known."""
    root, made = scratch(spark), stored(processed(spark, sf), "processed")
    io.write_raw(I.good_events(made), root, "events", compression="gzip")
    io.write_raw(I.bad_rows(made), root, "bad", compression="gzip")
    unstored(made)
    return flat(I.replay_bad(io.read_bad(spark, root), io.read_events(spark, root), {"1": V1}))


def _ended(job) -> None:
    """Wait for a job with the trigger ``availableNow``; an error in it is raised."""
    job.awaitTermination()


NOW = {"availableNow": True}
#: Requests of one landed file.
LANDED_ROWS = 20_000


def _streamed_ingest(spark, sf) -> str:
    """H1 over the corpus' bodies and pixel requests, landed as text files."""
    ship_package(spark)
    root, given = scratch(spark), bridge_requests(spark, sf)
    # A file is a task and so many files a micro-batch: both are bounded by the files' rows.
    for kind, column, folder in (("post", "body", "posts"), ("pixel", "e", "pixels")):
        given.where(F.col("kind") == kind).select(column).write.option("maxRecordsPerFile", LANDED_ROWS).text(f"{root}/{folder}", compression="gzip")
    _ended(ingest_stream(spark, f"{root}/posts", f"{root}/sink", f"{root}/checkpoint", NOW, pixels=f"{root}/pixels", compression="gzip"))
    return f"{root}/sink"


@register("ingest_stream_counts", O.with_ctes(IG, select=(
    "SELECT count(*) AS received, count(*) FILTER (WHERE len(errors) = 0) AS accepted, count(*) FILTER (WHERE len(errors) > 0) AS rejected FROM processed")))
def q_stream_counts(spark, sf):
    """The counts that the ingest stream's batches have written, over all of them."""
    counts = io.read_counts(spark, _streamed_ingest(spark, sf))
    return counts.agg(*(F.sum(c).alias(c) for c in ("received", "accepted", "rejected")))


@register("ingest_stream_good_events", O.with_ctes(IG, select=f"SELECT * EXCLUDE (ingested_at, dt) FROM ({OI.GOOD_EVENTS})"))
def q_stream_good(spark, sf):
    """H1: the raw stream that the ingest stream has written, but for its own time of arrival."""
    return flat(io.read_events(spark, _streamed_ingest(spark, sf)).drop("ingested_at", "dt", "event_date"))


def _landed_twice(spark, sf, run: Callable[[str], None]) -> None:
    """Call ``run`` with a raw folder that holds a part of the events, and again with all of them."""
    # By ingest date: a task writes few dates' files, so the streams read few files.
    root, e = scratch(spark), stored(ev(spark, sf).hint("rebalance", "dt"), "events")
    for part in (0, 1):
        io.write_raw(e.where(F.pmod(F.xxhash64("ingested_at", "session_id"), F.lit(2)) == part), root, "events")
        run(root)


@register("live_dedup_ids", O.with_ctes(select=(
    "SELECT event_id, CASE WHEN event_id IS NULL THEN count(*) ELSE 1 END AS events FROM contract_events GROUP BY event_id")))
def q_live_dedup(spark, sf):
    """H2: rows per id in the stream without duplicate deliveries, of a job that was started twice."""
    dest = scratch(spark)
    _landed_twice(spark, sf, lambda root: _ended(dedup_stream(spark, root, dest, f"{dest}/checkpoint", trigger=NOW)))
    return io.read_events(spark, dest).groupBy("event_id").agg(F.count(F.lit(1)).alias("events"))


@register("live_sessions_logged", O.with_ctes(DS, select="SELECT * EXCLUDE (derived_session_number) FROM derived_sessions"))
def q_live_sessions(spark, sf):
    """H3: the sessions that the log has arrived at, of a job that was started twice; rows of any age."""
    dest = scratch(spark)
    _landed_twice(spark, sf, lambda root: _ended(session_log_stream(spark, root, dest, f"{dest}/checkpoint", BRIDGE_CONFIG, horizon="36500 days", trigger=NOW)))
    return live_session_table(read_session_log(spark, dest))


# ---- E8, F8, H4 -------------------------------------------------------------------------------
@register("report_rejected_by_dt", O.with_ctes(IG, select=(
    "SELECT dt, bad_rows, array_to_string(list_sort(list_distinct(e))[:3], ' | ') AS sample_errors FROM "
    "(SELECT dt, count(*) AS bad_rows, flatten(list(errors)) AS e FROM processed WHERE len(errors) > 0 GROUP BY dt)")))
def q_rejected_by_dt(spark, sf):
    r = R.rejected_by_dt(I.bad_rows(processed(spark, sf)))
    return r.withColumn("sample_errors", F.array_join("sample_errors", " | "))


@register("journey_clean_params", O.with_ctes(select=(
    "SELECT json_extract(props, '$.k')::BIGINT AS k, false AS over_limit, count(*) AS calls FROM bridge_hits GROUP BY 1, 2")))
def q_clean_params(spark, sf):
    h = bridge_hits(spark, sf).select(J.clean_params(F.col("props")).alias("p"), J.params_over_limit(F.col("props")).alias("over_limit"))
    return (h.select(F.get_json_object("p", "$.k").cast("long").alias("k"), "over_limit").groupBy("k", "over_limit")
            .agg(F.count(F.lit(1)).alias("calls")))


_SKEW = "(epoch(event_timestamp) - epoch(ingested_at))"
_LABELS = [label for _, _, label in H.SKEW_BUCKETS] + [H.SKEW_OVERFLOW]


@register("live_quality_minutes", O.with_ctes(IG, select=(
    "SELECT date_trunc('minute', came) AS minute_start, count(*) FILTER (WHERE ok) AS events, count(*) FILTER (WHERE NOT ok) AS rejected, "
    + O.round_half_away("100.0 * count(*) FILTER (WHERE NOT ok) / count(*)", 2) + " AS reject_pct, count(id) AS with_event_id, "
    + ", ".join(f"count(*) FILTER (WHERE ok AND {O.skew_bucket_sql('skew')} = '{lab}') AS skew_bucket_{i}" for i, lab in enumerate(_LABELS))
    + ", count(*) FILTER (WHERE ok AND abs(skew) > 86400) AS untrusted_clock FROM ("
    f"SELECT ingested_at AS came, event_id AS id, {_SKEW} AS skew, true AS ok FROM contract_events "
    "UNION ALL SELECT ingested_at, NULL, NULL, false FROM processed WHERE len(errors) > 0) GROUP BY 1")))
def q_live_quality(spark, sf):
    return live_quality(ev(spark, sf), I.bad_rows(processed(spark, sf)))


# ---- scalar classifiers C1-C11, evaluated per distinct input after aggregation -------------
@register("classify_campaign_values", O.with_ctes(select=(
    "SELECT src AS source, med AS medium, camp AS campaign, events, "
    f"{O.is_engine_product('src')} AS is_engine_product, {O.is_paid('med')} AS is_paid_medium, "
    f"{O.is_shopping_source('src')} AS is_shopping_source, {O.is_search('src')} AS is_search_source, "
    f"{O.is_social('src')} AS is_social_source, {O.is_video('src')} AS is_video_source, "
    f"{O.channel_group('src', 'med', 'camp')} AS channel "
    "FROM (SELECT campaign.source AS src, campaign.medium AS med, campaign.campaign AS camp, count(*) AS events "
    "FROM contract_events GROUP BY 1, 2, 3)")))
def q_classify_campaign_values(spark, sf):
    g = (ev(spark, sf).groupBy(F.col("campaign.source").alias("source"), F.col("campaign.medium").alias("medium"),
                                F.col("campaign.campaign").alias("campaign"))
         .agg(F.count(F.lit(1)).alias("events")))
    s, m, c = F.col("source"), F.col("medium"), F.col("campaign")
    return g.select("source", "medium", "campaign", "events",
                    C.is_engine_product(s).alias("is_engine_product"), C.is_paid_medium(m).alias("is_paid_medium"),
                    C.is_shopping_source(s).alias("is_shopping_source"), C.is_search_source(s).alias("is_search_source"),
                    C.is_social_source(s).alias("is_social_source"), C.is_video_source(s).alias("is_video_source"),
                    C.channel_group(s, m, c).alias("channel"))


_REF_I = O.inferred("NULL", "NULL", "NULL", "NULL", "ref", O.DOMAINS)


@register("classify_referrers", O.with_ctes(select=(
    f"SELECT ref AS referrer, events, {O.referrer_host('ref')} AS referrer_host, "
    f"{O.is_internal(O.referrer_host('ref'), O.DOMAINS)} AS is_internal_host, "
    f"{O.engine_name(O.referrer_host('ref'))} AS engine_name, "
    f"{_REF_I['source']} AS inferred_source, {_REF_I['medium']} AS inferred_medium, "
    f"{_REF_I['attribution_from']} AS attribution_from "
    "FROM (SELECT page.referrer AS ref, count(*) AS events FROM contract_events GROUP BY 1)")))
def q_classify_referrers(spark, sf):
    g = ev(spark, sf).groupBy(F.col("page.referrer").alias("referrer")).agg(F.count(F.lit(1)).alias("events"))
    r = F.col("referrer")
    host = C.referrer_host(r)
    null = F.lit(None).cast("string")
    i = C.infer_traffic_source(null, null, null, null, r, BRIDGE_CONFIG.internal_domain_list())
    return g.select("referrer", "events", host.alias("referrer_host"),
                    C.is_internal_host(host, BRIDGE_CONFIG.internal_domain_list()).alias("is_internal_host"),
                    C.engine_name(host).alias("engine_name"), i.source.alias("inferred_source"),
                    i.medium.alias("inferred_medium"), i.attribution_from.alias("attribution_from"))
