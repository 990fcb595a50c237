"""Visitor journeys (F1-F10): the browser tag's visitor state re-derived from a log of
tag calls, for relayed or imported logs where no tag ran.

Input (``hits``): one row per tag call - ``anonymous_id, event_id, ts, event_name, url``
and optionally ``props`` (the call's params as JSON text).  Every per-visitor sequential
rule (inactivity sessions, last touch, previous page) runs as a chunked prefix scan
(``sequence.scan``), never as one window over a whole visitor.

Cookie lifetimes are expiry times: a cookie set at ``t`` with max-age ``m`` is gone at
``t + m``, so a value is still visible at ``now`` iff ``now - t < m``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpath.config import FIRST_TOUCH_TTL_SECONDS, LAST_TOUCH_TTL_SECONDS, MAX_PARAMS, SESSION_GAP_SECONDS, Config
from clickpath.operators.sequence import scan

# ---- fixed values of the tag -----------------------------------------------------------------
NAME_PATTERN = r"^[a-z][a-z0-9_]{0,39}\z"
UTM_FIELDS = ["source", "medium", "campaign", "content", "term"]
CLICK_ID_PARAMS = ["gclid", "fbclid"]
DERIVED_NAMES = ("session_start", "first_visit")
# ----------------------------------------------------------------------------------------------

MICROS = 1_000_000
_QUERY = r"^[^?#]*[?]([^#]*)"


def query_param(url: Column, name: str) -> Column:
    """first value of a URL query parameter, ``+`` and percent escapes decoded.

    Read the way browsers do: characters that a strict parser refuses (``|``, ``{}``) are
    themselves, and a ``%`` that begins no escape stands for itself.  NULL when absent, ''
    when empty."""
    query = F.concat(F.lit("&"), F.regexp_extract(url, _QUERY, 1))
    pattern = rf"&{name}(?:=([^&]*))?(?=&|\z)"
    value = F.replace(F.regexp_extract(query, pattern, 1), F.lit("+"), F.lit(" "))
    lone = F.replace(F.regexp_replace(value, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit(" "), F.lit("+"))
    return F.when(query.rlike(pattern), F.coalesce(F.try_url_decode(lone), value))


def observed_campaign(url: Column) -> Column:
    """the five ``utm_*`` of the page, or NULL when none is non-empty."""
    vals = {f: query_param(url, f"utm_{f}") for f in UTM_FIELDS}
    seen = F.lit(False)
    for v in vals.values():
        seen = seen | (F.coalesce(v, F.lit("")) != "")
    return F.when(seen, F.struct(*[v.alias(f) for f, v in vals.items()]))


def name_ok(name: Column) -> Column:
    """the tag drops calls whose name is not ``^[a-z][a-z0-9_]{0,39}$``."""
    return F.coalesce(name.rlike(NAME_PATTERN), F.lit(False))


def _scalars(props: Column) -> Column:
    """Scalar values by key, as ``map<string,variant>``: the JSON type of each is known."""
    return F.map_filter(F.from_json(props, "map<string,variant>"), lambda k, v: ~F.coalesce(
        F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)"), F.lit(False)))


def clean_params(props: Column) -> Column:
    """F8: keep scalar (string/number/boolean/null) values, in key order; none is cut off.

    More than the contract allows is a matter for :func:`params_over_limit` and the
    validator, which rejects the event with its params instead of losing some."""
    return F.when(props.isNotNull(), F.to_json(_scalars(props)))


def params_over_limit(props: Column) -> Column:
    """F8: whether more scalar params are left than an event may carry."""
    return F.coalesce(F.size(F.map_keys(_scalars(props))) > MAX_PARAMS, F.lit(False))


def journey_events(hits: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Per accepted tag call, the state the tag would have attached.

    session_id   F6: a call >= 30 min after the visitor's previous call opens a session,
                 whose id is the unix second of its first call (no midnight or campaign split)
    attribution  F5: ``first_touch`` on the visitor's first call, ``last_touch`` after
    utm_*        F3/F4: first call -> first touch (campaign seen on the first page, possibly
                 empty); later calls -> the latest non-empty campaign seen within 180 days,
                 else the first touch for two years (it is not minted anew after that)
    prev_path    F7: page views only - the previous page view's path if < 30 min ago
    gclid/fbclid F2: page views only, when non-empty in the URL

    One pass: every call gives one row, whether or not calls repeat or lack an id.
    """
    gap = (cfg.session_gap_seconds or SESSION_GAP_SECONDS) * MICROS
    ts, page_view = F.col("ts"), F.col("event_name") == "page_view"
    h = (hits.where(name_ok(F.col("event_name")))
         .select("anonymous_id", "event_id", "ts", "event_name",
                 F.regexp_extract(F.col("url"), r"^[a-z]+://[^/]+(/[^?#]*)?", 1).alias("page_path"),
                 observed_campaign(F.col("url")).alias("_seen"),
                 *[F.when(page_view, query_param(F.col("url"), p)).alias(p) for p in CLICK_ID_PARAMS]))

    def since(at: Column) -> Column:
        return F.unix_micros(ts) - F.unix_micros(at)

    def opens(previous: Column, now: Column) -> Column:
        return F.coalesce(F.unix_micros(now) - F.unix_micros(previous) >= gap, F.lit(True))

    seen = F.col("_seen")
    h = scan(h, "anonymous_id", "ts", {
        "_first": ("first", F.struct(ts.alias("at"), seen.alias("c"))),
        "_last": ("last", F.when(seen.isNotNull(), F.struct(ts.alias("at"), seen.alias("c")))),
        "_view": ("before", F.when(page_view, F.struct(ts.alias("at"), F.col("page_path").alias("path")))),
    }, ["event_id"], opens, cfg.chunks)
    first = F.col("is_first")
    held = F.when(F.coalesce(since(F.col("_first.at")) < FIRST_TOUCH_TTL_SECONDS * MICROS, F.lit(True)), F.col("_first.c"))
    camp = F.when(first, F.col("_first.c")).when(since(F.col("_last.at")) < LAST_TOUCH_TTL_SECONDS * MICROS, F.col("_last.c")).otherwise(held)
    return h.select(
        "anonymous_id", "event_id", "ts", "event_name", "page_path",
        F.floor(F.unix_micros(F.col("opened_at")) / MICROS).cast("long").cast("string").alias("session_id"),
        F.col("opened").alias("is_session_start"), first.alias("is_first_visit"),
        F.when(first, F.lit("first_touch")).otherwise(F.lit("last_touch")).alias("attribution"),
        *[camp[f].alias(f"utm_{f}") for f in UTM_FIELDS],
        *[F.when(F.coalesce(F.col(p), F.lit("")) != "", F.col(p)).alias(p) for p in CLICK_ID_PARAMS],
        F.when((F.col("event_name") == "page_view") & (since(F.col("_view.at")) < gap), F.col("_view.path")).alias("prev_path"),
    )


def journey_derived_rows(journey: DataFrame) -> DataFrame:
    """``session_start`` and ``first_visit`` rows, derived from ordering (never sent by
    the tag): one per session and one per visitor, stamped like the call that opened it."""
    base = ["anonymous_id", "session_id", "event_id", "ts", "page_path", "attribution"]
    starts = (journey.where(F.col("is_session_start")).select(*base)
              .withColumn("event_name", F.lit(DERIVED_NAMES[0])))
    firsts = (journey.where(F.col("is_first_visit")).select(*base)
              .withColumn("event_name", F.lit(DERIVED_NAMES[1])))
    return starts.unionByName(firsts)


def journey_sessions(journey: DataFrame) -> DataFrame:
    """F6 rolled up: calls, page views and the entry/exit page per (visitor, session)."""
    order = F.struct(F.col("ts"), F.col("event_id"))
    return (journey.groupBy("anonymous_id", "session_id")
            .agg(F.min("ts").alias("session_start"), F.max("ts").alias("session_end"),
                 F.count(F.lit(1)).alias("events"),
                 F.count_if(F.col("event_name") == "page_view").alias("page_views"),
                 F.min_by("page_path", order).alias("entry_path"),
                 F.max_by("page_path", order).alias("exit_path")))
