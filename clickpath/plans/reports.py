"""Report queries E1-E18 over ``events`` (contract rows + dt + event_date) and ``sessions``.

Sorts match the printed report; every sort carries a full tie-break so top-k results are
deterministic, and NULLs sort last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpath.functions.clock import round_half_away
from clickpath.storage import stored

TOP_K = 10


def volume(events: DataFrame) -> DataFrame:
    """Events, visitors, sessions = distinct (visitor, session_id) pairs, first/last event.

    Distinct pairs as a struct so a pair with a NULL member still counts."""
    return events.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("anonymous_id").alias("visitors"),
        F.count_distinct(F.struct("anonymous_id", "session_id")).alias("sessions"),
        F.min("event_timestamp").alias("first_event"),
        F.max("event_timestamp").alias("last_event"),
    )


def ingest_vs_event_date(events: DataFrame) -> DataFrame:
    """Ingest partition x client event date."""
    return (events.groupBy(F.col("dt").alias("ingest_partition"), "event_date")
            .agg(F.count(F.lit(1)).alias("events"))
            .orderBy(F.col("ingest_partition").asc_nulls_last(), F.col("event_date").asc_nulls_last()))


def sessions_by_channel(sessions: DataFrame) -> DataFrame:
    """Sessions, page views and average duration per channel."""
    return (sessions.groupBy("channel")
            .agg(F.count(F.lit(1)).alias("sessions"), F.sum("page_views").alias("page_views"),
                 round_half_away(F.avg("duration_seconds"), 1).alias("avg_seconds"))
            .orderBy(F.desc("sessions"), F.asc_nulls_last("channel")))


def acquisition(sessions: DataFrame) -> DataFrame:
    """Channel / source / medium / campaign with display sentinels."""
    return (sessions.groupBy("channel",
                             F.coalesce("source", F.lit("(direct)")).alias("source"),
                             F.coalesce("medium", F.lit("(none)")).alias("medium"),
                             F.coalesce("campaign_name", F.lit("(not set)")).alias("campaign"))
            .agg(F.count(F.lit(1)).alias("sessions"))
            .orderBy(F.desc("sessions"), "channel", "source", "medium", "campaign"))


def entry_pages(sessions: DataFrame, k: int = TOP_K) -> DataFrame:
    """E5: top entry pages (top-k is the feature; ties broken by path)."""
    return (sessions.where(F.col("entry_path").isNotNull())
            .groupBy("entry_path")
            .agg(F.count(F.lit(1)).alias("sessions"), F.sum("page_views").alias("page_views"))
            .orderBy(F.desc("sessions"), "entry_path").limit(k))


def events_by_name(events: DataFrame) -> DataFrame:
    """Events and distinct visitors per event name."""
    return (events.groupBy("event_name")
            .agg(F.count(F.lit(1)).alias("events"), F.count_distinct("anonymous_id").alias("visitors"))
            .orderBy(F.desc("events"), F.asc_nulls_last("event_name")))


def client_vs_gap_sessions(sessions: DataFrame, derived_sessions: DataFrame) -> DataFrame:
    """Client-assigned sessions vs sessions re-derived from the 30-minute rule.

    Only the rows of both are counted: ``sessions`` may be the distinct session keys alone."""
    a = sessions.agg(F.count(F.lit(1)).alias("client_assigned"))
    b = derived_sessions.agg(F.count(F.lit(1)).alias("derived_from_gap"))
    return a.crossJoin(b).withColumn("difference", F.col("client_assigned") - F.col("derived_from_gap"))


def rejected_by_dt(bad: DataFrame, samples: int = 3) -> DataFrame:
    """Rejected rows per ingest date with up to three distinct sample errors.

    The rows' dates and errors are stored once.  A date's distinct errors are found by
    pre-aggregation, and only its ``samples`` smallest of every task reach the window."""
    rows = stored(bad.select("dt", "errors"), "rejected")
    counts = rows.groupBy("dt").agg(F.count(F.lit(1)).alias("bad_rows"))
    errors = rows.select("dt", F.explode("errors").alias("error")).distinct()
    nth = F.row_number().over(Window.partitionBy("dt").orderBy("error"))
    least = errors.withColumn("_nth", nth).where(F.col("_nth") <= samples).groupBy("dt").agg(F.array_sort(F.collect_list("error")).alias("sample_errors"))
    listed = F.coalesce("sample_errors", F.array().cast("array<string>"))
    both = counts.withColumnRenamed("dt", "_dt").join(least, F.col("_dt").eqNullSafe(F.col("dt")), "left")
    return both.select(F.col("_dt").alias("dt"), "bad_rows", listed.alias("sample_errors")).orderBy("dt")


def clock_skew_report(skew: DataFrame) -> DataFrame:
    """E9."""
    return skew.orderBy(F.desc("events"), "bucket")


def tagging_report(tagging: DataFrame, k: int = TOP_K) -> DataFrame:
    """Top tagging defects."""
    return tagging.orderBy(F.desc("sessions"), "channel", "source", "campaign").limit(k)


def attribution_provenance(sessions: DataFrame) -> DataFrame:
    """Sessions per attribution rule and share of all sessions.

    The total sums the grouped rows (one per rule), so sessions are computed once."""
    g = sessions.groupBy("attribution_from").agg(F.count(F.lit(1)).alias("sessions"))
    total = F.sum("sessions").over(Window.partitionBy(F.lit(1)))
    return (g.select("attribution_from", "sessions", round_half_away(F.lit(100.0) * F.col("sessions") / total, 1).alias("pct"))
            .orderBy(F.desc("sessions"), "attribution_from"))


def robotic_report(robotic: DataFrame, k: int = TOP_K) -> DataFrame:
    """E13."""
    return robotic.orderBy(F.desc("sessions"), "entry_path").limit(k)


def by_sessions_desc(df: DataFrame, *tiebreak: str) -> DataFrame:
    """Scanner, non-production and preview reports."""
    return df.orderBy(F.desc("sessions"), *tiebreak)


def dt_vs_event_date(events: DataFrame, pad_days: int = 1) -> DataFrame:
    """The silent-zero trap as a query.

    Per client event date: the true count (filter on ``event_date``), what a filter on the
    ingest date ``dt`` alone returns, and what a ``dt`` filter padded by +/- ``pad_days``
    captures - with the captured fraction.  Padding is a pruning optimisation with a
    measurable loss, never a correctness guarantee."""
    d = F.col("event_date")
    same = F.count_if(F.col("dt") == d)
    padded = F.count_if((F.col("dt") >= F.date_sub(d, pad_days)) & (F.col("dt") <= F.date_add(d, pad_days)))
    g = (events.groupBy("event_date")
         .agg(F.count(F.lit(1)).alias("events"), same.alias("same_dt_events"),
              padded.alias("padded_dt_events")))
    return g.withColumn("padded_capture_pct",
                        round_half_away(F.lit(100.0) * F.col("padded_dt_events") / F.col("events"), 2))


def prune_by_ingest(events: DataFrame, lo, hi, pad_days: int = 1) -> tuple[DataFrame, DataFrame]:
    """Opt-in ``event_date`` range filter that also prunes ``dt`` partitions (+/- pad).

    Events whose clock is further off than the pad are lost to the first DataFrame; the
    second is one row that says how many: ``events`` in the range, ``kept``, ``lost``."""
    lo_c, hi_c = F.to_date(F.lit(lo)), F.to_date(F.lit(hi))
    wanted = F.col("event_date").between(lo_c, hi_c)
    near = F.col("dt").between(F.date_sub(lo_c, pad_days), F.date_add(hi_c, pad_days))
    loss = events.agg(F.count_if(wanted).alias("events"), F.count_if(wanted & F.coalesce(near, F.lit(False))).alias("kept"))
    return events.where(near & wanted), loss.withColumn("lost", F.col("events") - F.col("kept"))
