"""Data-quality views (D6-D12): diagnostics, never filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.functions.channels import SCANNER_HOSTS
from clickpath.functions.clock import round_half_away, skew_seconds

# ---- fixed values: health thresholds and patterns -------------------------------------------
SKEW_BUCKETS = [  # (upper bound in seconds, inclusive?, label); last bucket catches the rest
    (-86400, False, "client >1d behind (pad misses these)"),
    (-300, False, "client 5m-1d behind"),
    (300, True, "within 5 min"),
    (86400, True, "client 5m-1d ahead"),
]
SKEW_OVERFLOW = "client >1d ahead (pad misses these)"
ROBOTIC_MIN_SESSIONS = 20
ROBOTIC_MIN_SINGLE_HIT_PCT = 95
NONPROD_HOST_PATTERN = (r"^(localhost|127\.0\.0\.1)([:.]|$)"
                        r"|^(develop|dev|staging|stage|test|testing|preview|homolog|hml|qa|sandbox)\.")
PREVIEW_MEDIUMS = ["test", "preview"]
# ---------------------------------------------------------------------------------------------


def skew_bucket(skew):
    out = None
    for bound, inclusive, label in SKEW_BUCKETS:
        cond = skew <= bound if inclusive else skew < bound
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(SKEW_OVERFLOW)


def health_clock_skew(events: DataFrame) -> DataFrame:
    """Events per clock-skew bucket with min/max skew in days."""
    x = events.select(skew_seconds(F.col("event_timestamp"), F.col("ingested_at")).alias("skew"))
    return (x.groupBy(skew_bucket(F.col("skew")).alias("bucket"))
             .agg(F.count(F.lit(1)).alias("events"),
                  round_half_away(F.min("skew") / F.lit(86400.0), 2).alias("min_days"),
                  round_half_away(F.max("skew") / F.lit(86400.0), 2).alias("max_days")))


def health_event_id(events: DataFrame) -> DataFrame:
    """event_id coverage, then duplicate deliveries within the covered slice."""
    x = events.agg(F.count(F.lit(1)).alias("events"),
                   F.count("event_id").alias("with_event_id"),
                   F.count_distinct("event_id").alias("_distinct"))
    dup = F.col("with_event_id") - F.col("_distinct")
    return x.select(
        "events", "with_event_id",
        round_half_away(F.lit(100.0) * F.col("with_event_id") / F.nullif(F.col("events"), F.lit(0)), 1)
        .alias("coverage_pct"),
        dup.alias("duplicate_deliveries"),
        round_half_away(F.lit(100.0) * dup / F.nullif(F.col("with_event_id"), F.lit(0)), 2)
        .alias("duplicate_pct_of_covered"),
    )


def health_tagging(sessions: DataFrame) -> DataFrame:
    """Campaign set but medium empty -> paid traffic counted as organic."""
    return (sessions.where(F.col("campaign_name").isNotNull()
                           & (F.col("medium").isNull() | (F.col("medium") == "")))
            .groupBy("channel",
                     F.coalesce("source", F.lit("(direct)")).alias("source"),
                     F.coalesce("campaign_name", F.lit("(not set)")).alias("campaign"))
            .agg(F.count(F.lit(1)).alias("sessions")))


def health_robotic_paths(sessions: DataFrame) -> DataFrame:
    """Entry paths with >= 20 sessions of which >= 95 % are single page views."""
    single = F.count_if(F.col("page_views") == 1)
    g = (sessions.where(F.col("entry_path").isNotNull())
         .groupBy("entry_path")
         .agg(F.count(F.lit(1)).alias("sessions"), single.alias("single_hit_sessions"),
              F.count_distinct("anonymous_id").alias("visitors")))
    pct = F.lit(100.0) * F.col("single_hit_sessions") / F.col("sessions")
    return (g.where((F.col("sessions") >= ROBOTIC_MIN_SESSIONS) & (pct >= ROBOTIC_MIN_SINGLE_HIT_PCT))
             .select("entry_path", "sessions", "single_hit_sessions",
                     round_half_away(pct, 1).alias("single_hit_pct"), "visitors"))


def _host_counts(sessions: DataFrame, cond) -> DataFrame:
    return (sessions.where(cond).groupBy("entry_hostname")
            .agg(F.count(F.lit(1)).alias("sessions"), F.count_distinct("anonymous_id").alias("visitors")))


def health_scanner_traffic(sessions: DataFrame) -> DataFrame:
    """The tag platform's own scanner host, counted as traffic."""
    return _host_counts(sessions, F.col("entry_hostname").isin(SCANNER_HOSTS))


def health_nonprod_hostnames(sessions: DataFrame) -> DataFrame:
    """Development / staging hosts writing into the production sink."""
    return _host_counts(sessions, F.coalesce("entry_hostname", F.lit("")).rlike(NONPROD_HOST_PATTERN))


def health_preview_traffic(sessions: DataFrame) -> DataFrame:
    """The site's own tag debugging, counted as traffic."""
    cond = (F.lower(F.coalesce("source", F.lit(""))).contains("preview")
            | F.lower(F.coalesce("medium", F.lit(""))).isin(PREVIEW_MEDIUMS))
    return (sessions.where(cond)
            .groupBy(F.coalesce("source", F.lit("(direct)")).alias("source"),
                     F.coalesce("medium", F.lit("(none)")).alias("medium"))
            .agg(F.count(F.lit(1)).alias("sessions")))
