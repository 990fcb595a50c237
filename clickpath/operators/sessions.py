"""Sessions (D2) and gap re-derived sessions (D3)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath.config import Config
from clickpath.functions.channels import channel_group, infer_traffic_source, referrer_host
from clickpath.functions.clock import boundary_diff
from clickpath.operators.sequence import number_sessions
from clickpath.sources import layer
from clickpath.sources.buckets import Bucketed
from clickpath.sources.schema import EVENT_SCHEMA

SESSION_COLUMNS = [
    "anonymous_id", "session_id", "session_start", "session_end", "duration_seconds", "events",
    "page_views", "entry_path", "exit_path", "entry_hostname", "referrer", "source", "medium",
    "campaign_name", "attribution_from", "attribution", "channel", "session_date",
]


def sessions(events: DataFrame, cfg: Config = Config(), time_col: str = "event_timestamp") -> DataFrame:
    """One row per (anonymous_id, session_id) - never session_id alone.

    Attribution is taken at session start: every ``first_*`` column is the earliest
    NON-NULL value of that column in the session, each column on its own (a campaign
    arriving on the second page view still attributes the session).  One aggregation, one
    shuffle on the session key, with map-side partial aggregation so a huge session is
    pre-combined before it moves.  Ties on the timestamp break on (ingested_at, event_id)
    so results are deterministic.

    ``time_col`` orders the session; ``event_time`` on the derived layer closes the
    backdating hole of the client clock.
    """
    ts = F.col(time_col)
    order = F.struct(ts, F.col("ingested_at"), F.col("event_id"))

    def first(c: Column) -> Column:
        return F.min_by(c, F.when(c.isNotNull() & ts.isNotNull(), order))

    def last(c: Column) -> Column:
        return F.max_by(c, F.when(c.isNotNull() & ts.isNotNull(), order))

    agg = events.groupBy("anonymous_id", "session_id").agg(
        F.min(ts).alias("session_start"),
        F.max(ts).alias("session_end"),
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_name") == "page_view").alias("page_views"),
        first(F.col("page.path")).alias("entry_path"),
        last(F.col("page.path")).alias("exit_path"),
        first(F.col("page.url")).alias("entry_url"),
        first(F.col("page.referrer")).alias("referrer"),
        first(F.col("campaign.source")).alias("utm_source"),
        first(F.col("campaign.medium")).alias("utm_medium"),
        first(F.col("campaign.campaign")).alias("utm_campaign"),
        first(F.col("campaign.attribution")).alias("attribution"),
        first(F.get_json_object(F.col("params"), "$.gclid")).alias("click_id"),
    )
    return _classified(agg, cfg)


def bucketed_sessions(events: Bucketed, cfg: Config = Config(), time_col: str = "event_timestamp") -> DataFrame:
    """D2 over a table bucketed by visitor, or by visitor and session: its buckets move no rows.

    Only the rows apart (sessions that would crowd a bucket, keys with NULLs) are pre-aggregated
    and exchanged."""
    if not set(events.by) <= {"anonymous_id", "session_id"}:
        raise ValueError(f"sessions need buckets of visitors or sessions, not of {events.by}")
    return sessions(events.rows, cfg, time_col).unionByName(sessions(events.apart, cfg, time_col))


def _classified(agg: DataFrame, cfg: Config) -> DataFrame:
    """Session rows from the aggregated columns: inferred source, channel, duration."""
    i = infer_traffic_source(F.col("utm_source"), F.col("utm_medium"), F.col("utm_campaign"),
                             F.col("click_id"), F.col("referrer"), cfg.internal_domain_list())
    return (agg.withColumn("_i", i)
               .select(
                   "anonymous_id", "session_id", "session_start", "session_end",
                   boundary_diff("second", F.col("session_start"), F.col("session_end")).alias("duration_seconds"),
                   "events", "page_views", "entry_path", "exit_path",
                   referrer_host(F.col("entry_url")).alias("entry_hostname"),
                   "referrer",
                   F.col("_i.source").alias("source"),
                   F.col("_i.medium").alias("medium"),
                   F.col("_i.campaign").alias("campaign_name"),
                   F.col("_i.attribution_from").alias("attribution_from"),
                   "attribution",
                   channel_group(F.col("_i.source"), F.col("_i.medium"), F.col("_i.campaign")).alias("channel"),
                   F.to_date("session_start").alias("session_date"),
               ))


#: Columns of a session that are its first or last non-NULL value, by the columns' names above.
_FIRSTS = {"entry_path": "page.path", "entry_url": "page.url", "referrer": "page.referrer", "utm_source": "campaign.source",
           "utm_medium": "campaign.medium", "utm_campaign": "campaign.campaign", "attribution": "campaign.attribution"}


def session_states(events: DataFrame, time_col: str = "event_timestamp", by: tuple[str, ...] = ()) -> DataFrame:
    """D2, mergeable: what :func:`merged_sessions` needs of a part of the events, per session (and ``by``).

    A first value is kept with its order key, so parts may come in any order and at any size."""
    ts = F.col(time_col)

    def kept(value: Column) -> Column:
        return F.when(value.isNotNull() & ts.isNotNull(), F.struct(ts.alias("ts"), F.col("ingested_at"), F.col("event_id"), value.alias("value")))

    firsts = {**{n: F.col(c) for n, c in _FIRSTS.items()}, "click_id": F.get_json_object(F.col("params"), "$.gclid")}
    return events.groupBy("anonymous_id", "session_id", *by).agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_name") == "page_view").alias("page_views"),
        *(F.min(kept(c)).alias(n) for n, c in firsts.items()), F.max(kept(F.col("page.path"))).alias("exit_path"))


def merged_sessions(states: DataFrame, cfg: Config = Config()) -> DataFrame:
    """D2 from :func:`session_states` of any parts that make up the events."""
    firsts = [*_FIRSTS, "click_id"]
    agg = states.groupBy("anonymous_id", "session_id").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), F.sum("events").alias("events"), F.sum("page_views").alias("page_views"),
        *(F.min(n).alias(n) for n in firsts), F.max("exit_path").alias("exit_path"))
    return _classified(agg.withColumns({n: F.col(n)["value"] for n in (*firsts, "exit_path")}), cfg)


def fold_sessions(raw: DataFrame, dest: str, dates: list, time_col: str = "event_timestamp") -> None:
    """Add, or replace, the session states of the ingest ``dates`` (None: rows without one).

    ``raw`` are the events of those dates; nothing else is read.  A folder holds the states of
    an ingest date, and a manifest names the current ones, so a reader sees all of a fold or
    nothing, and a date folded again replaces itself."""
    spark, manifest, folder = raw.sparkSession, layer.current(raw.sparkSession, dest), layer.new_folder("index")
    states = session_states(raw, time_col, by=("dt",))
    states.repartition("dt", "anonymous_id").write.partitionBy("dt").parquet(f"{dest}/{folder}")
    there = {x.split("=", 1)[1]: f"{folder}/{x}" for x in layer.folders(spark, f"{dest}/{folder}", "dt=")}
    kept = {d: x for d, x in (manifest.index or {}).items() if d not in {layer.NO_DATE if d is None else str(d) for d in dates}}
    layer.commit(spark, dest, manifest, None, kept | there)


def read_sessions(spark: SparkSession, dest: str, cfg: Config = Config()) -> DataFrame:
    """D2 over all ingest dates folded into ``dest``, from their states alone."""
    shape = session_states(spark.createDataFrame([], EVENT_SCHEMA)).schema
    paths = [f"{dest}/{x}" for _, x in sorted((layer.current(spark, dest).index or {}).items())]
    states = spark.read.schema(shape).parquet(*paths) if paths else spark.createDataFrame([], shape)
    return merged_sessions(states, cfg)


def gap_session_numbers(events: DataFrame, cfg: Config = Config(), time_col: str = "event_timestamp",
                        mode: str = "boundary") -> DataFrame:
    """Number every event's session under the inactivity rule, per visitor.

    ``mode="boundary"``: a row opens a session when the *minute boundaries* crossed since
    the visitor's previous row are >= gap/60 (the warehouse rule; 10:00:59 -> 10:30:01
    counts 30).  ``mode="elapsed"``: when the elapsed time is >= gap seconds (the tag's
    cookie rule).  The first row of a visitor always opens a session.
    """
    gap = cfg.session_gap_seconds
    if mode == "boundary":
        def is_new(prev, ts):
            return F.coalesce(boundary_diff("minute", prev, ts), F.lit(9999)) >= gap // 60
    else:
        def is_new(prev, ts):
            return F.coalesce((F.unix_micros(ts) - F.unix_micros(prev)) >= gap * 1_000_000, F.lit(True))
    return number_sessions(events, "anonymous_id", time_col, is_new, tiebreak=["ingested_at", "event_id"],
                           out="derived_session_number", chunks=cfg.chunks)


def derived_sessions(events: DataFrame, cfg: Config = Config(), time_col: str = "event_timestamp") -> DataFrame:
    """D3: sessions re-derived from 30 minutes of inactivity, ignoring the client's id.

    A data-quality check on the client's cookie logic: compare its count with D2's."""
    needed = [c for c in events.columns if c in ("anonymous_id", "session_id", "ingested_at", "event_id", time_col)]
    numbered = gap_session_numbers(events.select(*needed), cfg, time_col)
    return numbered.groupBy("anonymous_id", "derived_session_number").agg(
        F.min("session_id").alias("client_session_id"),
        F.count_distinct("session_id").alias("distinct_client_session_ids"),
        F.min(time_col).alias("session_start"),
        F.count(F.lit(1)).alias("events"),
    )
