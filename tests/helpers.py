"""Build small contract-event DataFrames for hand-authored cases."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clickpath.sources.schema import EVENT_SCHEMA


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text.replace("Z", "+00:00")).replace(tzinfo=None)


def event(**kw) -> dict:
    base = {
        "schema_version": "0", "event_id": None, "event_name": "page_view",
        "event_timestamp": "2026-07-28T12:00:00Z", "ingested_at": "2026-07-28T12:00:01Z",
        "anonymous_id": "anon_0000001", "session_id": "1785240000", "user_id": None,
        "page": {"url": "https://www.example.com/", "path": "/", "title": None, "referrer": None},
        "campaign": {"source": None, "medium": None, "campaign": None, "content": None, "term": None,
                     "attribution": "last_touch"},
        "device": {"platform": "web", "user_agent": "ua", "language": "en", "screen_width": 1, "screen_height": 1},
        "params": None,
    }
    base.update(kw)
    for k in ("event_timestamp", "ingested_at"):
        if isinstance(base[k], str):
            base[k] = ts(base[k])
    return base


def events_df(spark, rows: list[dict]):
    # Spark session time zone is UTC, so naive datetimes are read as UTC wall clock.
    df = spark.createDataFrame([tuple(r[f.name] for f in EVENT_SCHEMA.fields) for r in rows], EVENT_SCHEMA)
    return df.withColumn("dt", F.to_date("ingested_at")).withColumn("event_date", F.to_date("event_timestamp"))
