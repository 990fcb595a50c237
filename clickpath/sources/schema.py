"""Declared schemas.  Never inferred: a dataset where no row carries ``page`` must still
have a ``page`` column, and column types must not drift between runs."""

from __future__ import annotations

from pyspark.sql import types as T

PAGE = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("referrer", T.StringType()),
])

CAMPAIGN = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("medium", T.StringType()),
    T.StructField("campaign", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("term", T.StringType()),
    T.StructField("attribution", T.StringType()),
])

DEVICE = T.StructType([
    T.StructField("platform", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("screen_width", T.LongType()),
    T.StructField("screen_height", T.LongType()),
])

# One contract event as stored in the raw good stream (params kept as raw JSON text).
EVENT_SCHEMA = T.StructType([
    T.StructField("schema_version", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("anonymous_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("page", PAGE),
    T.StructField("campaign", CAMPAIGN),
    T.StructField("device", DEVICE),
    T.StructField("params", T.StringType()),
])

EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]

# A rejected row: either the parsed payload (as JSON text) or the raw body text.
BAD_SCHEMA = T.StructType([
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("collector_instance", T.StringType()),
    T.StructField("errors", T.ArrayType(T.StringType())),
    T.StructField("payload", T.StringType()),
    T.StructField("payload_raw", T.StringType()),
])

BAD_COLUMNS = [f.name for f in BAD_SCHEMA.fields]

# Columns the derived layer adds (event_date is replaced by the trusted date).
DERIVED_EXTRA = ["skew_seconds", "event_time_trusted", "event_time", "event_date"]
# The derived layer's files also hold the date of ingest that a row came from.
INGEST_DATE = "_dt"
DERIVED_SCHEMA = T.StructType([
    *EVENT_SCHEMA.fields,
    T.StructField("skew_seconds", T.DoubleType()),
    T.StructField("event_time_trusted", T.BooleanType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField(INGEST_DATE, T.DateType()),
    T.StructField("event_date", T.DateType()),
])

# Contract rules (fixed values of the event contract v0).
SCHEMA_VERSION = "0"
EVENT_NAME_PATTERN = r"^[a-z][a-z0-9_]{0,39}$"
ID_MIN_LEN, ID_MAX_LEN = 8, 64
USER_ID_MAX_LEN = 128
CAMPAIGN_FIELD_MAX_LEN = 250
ATTRIBUTION_VALUES = ["first_touch", "last_touch"]
PLATFORM_VALUES = ["web", "android", "ios", "server"]
REQUIRED_FIELDS = ["schema_version", "event_name", "event_timestamp", "anonymous_id", "session_id"]
RESERVED_EVENT_NAMES = ["page_view", "session_start", "first_visit"]
