"""Test-data bridge: contract events derived from the driver's ``events`` + ``pages`` tables.

The driver's tables do not carry the event contract, so contract rows are built by
arithmetic on the numeric ``event_id`` (``n``) joined to ``pages`` on ``page_id = n`` modulo
the number of pages, so every page is used.
The same definition exists twice: as Spark code (``bridge_events``) and as a DuckDB CTE
(``BRIDGE_SQL``) that every oracle query starts from.  Both are generated from the fixed
tables below, so they cannot drift apart.

Definition (all branches on ``n``; ``/`` between integers is integer division):
  event_name       'page_view' if n%25=4 or event_type='view', else event_type
  ingested_at      n%50: 7 -> ts+2d, 8 -> ts-2d, 9 -> ts+10min, 10 -> ts-10min, else ts+1s
  event_id         NULL if n%10=3 else 'evt_' + n left-padded to 10
  anonymous_id     'anon_' + user_id left-padded to 8
  session_id       n%25=4 -> 'bot_' + n padded (one-hit session); else the unix second of
                   ts's UTC day, as text
  page.url         n%25=4 -> robotic path; n%97 in 13,14,15 -> scanner, localhost, staging;
                   else pages.url
  page.referrer    by (n/32)%8, REFERRERS
  campaign         by n%32, CAMPAIGNS; attribution 'first_touch' if n%3=0 else 'last_touch'
  params           {"gclid":"g<n>"} if n%41=5 else NULL
  duplicates       every row with n%20=0 is delivered twice, the copy ingested 9 s later

Tag calls (``bridge_hits``, input of the journey jobs): one per driver event, two equal ones
when n%20=0, ``event_id`` NULL when n%10=3, the page URL of the bridge or, by n%23, one of
``AD_URLS``, and the call's name upper-cased when n%30=2 (a name the tag refuses).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath.config import Config
from clickpath.operators.ingest import small_methods
from clickpath.sources.io import spread_small

# ---- fixed values of the bridge ------------------------------------------------------------
INTERNAL_DOMAINS = "example.com.br"
ROBOT_URL = "https://www.example.com/render"
SPECIAL_URLS = {13: "https://gtm-msr.appspot.com/a", 14: "http://localhost:8080/x",
                15: "https://staging.example.com/x"}
AD_URLS = {5: "https://www.example.com/land?utm_source={src}&utm_campaign=a|b",
           6: "https://www.example.com/sale?utm_campaign=50%off&utm_medium=e%2Dmail+x&gclid=G%31#now",
           7: "https://www.example.com/x?other=1&utm_source=&utm_term", 8: "https://www.example.com/y?utm_source=mailing&fbclid=f"}
PATH_PATTERN = r"^[a-z]+://[^/]+(/[^?#]*)?"
REFERRERS = [
    None,
    "https://www.google.com/search?q=x",
    "https://br.search.yahoo.com/s",
    "https://mail.google.com/mail",
    "https://www.youtube.com/watch?v=1",
    "android-app://com.google.android.gm",
    "https://app.example.com.br/x",
    "https://blog.example.org/post",
]
CAMPAIGNS = [  # (source, medium, campaign) by n % 32; 22..31 all NULL
    ("google", "cpc", "brand"),
    ("amazon", "cpc", "sale"),
    ("fb ", "cpc", "social_q1"),
    ("youtube", "cpc", "video_q1"),
    ("doubleclick", "cpm", "awareness"),
    ("partnerx", "paid", "px"),
    ("shopee", "referral", None),
    ("instagram.com", "referral", None),
    ("vimeo", None, None),
    ("google", "organic", None),
    ("chatgpt.com", "referral", None),
    ("newsletter", "email", "digest"),
    ("bargainclub", "affiliate", "autumn"),
    ("podcastnet", "audio", "ep12"),
    ("txtmail", "sms", None),
    ("app", "push", None),
    ("news.example.org", "referral", None),
    ("google", "cpc", "spring cross-network"),
    ("mystery", "unheard", None),
    ("google", None, "untagged"),
    ("gtm_preview", "test", None),
    ("", "", None),
]
DEVICE = ("web", "Mozilla/5.0 (bridge)", "en-US", 1280, 720)
# ---------------------------------------------------------------------------------------------

BRIDGE_CONFIG = Config(internal_domains=INTERNAL_DOMAINS)


def _pick(index, values):
    """CASE index WHEN i THEN values[i] ... as a Column."""
    out = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string")
        out = F.when(index == i, lit) if out is None else out.when(index == i, lit)
    return out


def _url(n):
    m25, m97 = F.pmod(n, F.lit(25)), F.pmod(n, F.lit(97))
    url = F.when(m25 == 4, F.lit(ROBOT_URL))
    for k, u in SPECIAL_URLS.items():
        url = url.when(m97 == k, F.lit(u))
    return url.otherwise(F.col("page_url"))


def _event_name(n):
    return (F.when((F.pmod(n, F.lit(25)) == 4) | (F.col("event_type") == "view"), F.lit("page_view"))
            .otherwise(F.col("event_type")))


def _with_pages(spark: SparkSession, sf_dir: str, cols: list[str]) -> DataFrame:
    ev = spread_small(spark.read.parquet(f"{sf_dir}/events.parquet").select(*cols), f"{sf_dir}/events.parquet")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.col("url").alias("page_url"))
    total = pages.agg(F.count(F.lit(1)).alias("_pages"))       # one row
    base = (ev.crossJoin(F.broadcast(total))
            .withColumn("page_id", F.pmod(F.col("event_id"), F.nullif(F.col("_pages"), F.lit(0)))).drop("_pages"))
    return base.join(pages, "page_id", "left")


def _with_copies(rows: DataFrame) -> DataFrame:
    """Duplicate delivery without a second scan: n%20=0 rows explode into two copies."""
    twice = F.pmod(F.col("event_id"), F.lit(20)) == 0
    return rows.withColumn("copy", F.explode(F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))


def bridge_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag calls: (anonymous_id, event_id, ts, event_name, url, props)."""
    rows = _with_copies(_with_pages(spark, sf_dir, ["event_id", "ts", "user_id", "event_type", "props"]))
    n = F.col("event_id")
    name = _event_name(n)
    url = _url(n)
    for k, ad in AD_URLS.items():
        url = F.when(F.pmod(n, F.lit(23)) == k, F.lit(ad)).otherwise(url)
    return rows.select(
        F.concat(F.lit("anon_"), F.lpad(F.col("user_id").cast("string"), 8, "0")).alias("anonymous_id"),
        F.when(F.pmod(n, F.lit(10)) != 3, F.concat(F.lit("evt_"), F.lpad(n.cast("string"), 10, "0"))).alias("event_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.pmod(n, F.lit(30)) == 2, F.upper(name)).otherwise(name).alias("event_name"),
        url.alias("url"),
        F.col("props"),
    )


def bridge_events(spark: SparkSession, sf_dir: str, keep_keys: bool = False) -> DataFrame:
    """Contract events (EVENT_SCHEMA + ``dt`` + ``event_date``) from the driver tables.

    ``keep_keys`` also returns the bridge key ``bridge_n`` and the delivery ``copy``."""
    small_methods(spark)
    rows = _with_copies(_with_pages(spark, sf_dir, ["event_id", "ts", "user_id", "event_type"]))
    n = F.col("event_id")

    ts = F.col("ts").cast("timestamp")
    m50, m25, m97, m32 = (F.pmod(n, F.lit(k)) for k in (50, 25, 97, 32))
    pad_n = F.lpad(n.cast("string"), 10, "0")
    ingested = (
        F.when(m50 == 7, ts + F.expr("INTERVAL 2 DAYS"))
        .when(m50 == 8, ts - F.expr("INTERVAL 2 DAYS"))
        .when(m50 == 9, ts + F.expr("INTERVAL 10 MINUTES"))
        .when(m50 == 10, ts - F.expr("INTERVAL 10 MINUTES"))
        .otherwise(ts + F.expr("INTERVAL 1 SECOND"))
    ) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("copy") * 9)
    url = _url(n)
    idx = m32
    src = _pick(idx, [c[0] for c in CAMPAIGNS])
    med = _pick(idx, [c[1] for c in CAMPAIGNS])
    camp = _pick(idx, [c[2] for c in CAMPAIGNS])
    ref_idx = F.pmod(F.floor(n / F.lit(32)).cast("long"), F.lit(8))
    out = rows.select(
        F.lit("0").alias("schema_version"),
        F.when(F.pmod(n, F.lit(10)) == 3, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("evt_"), pad_n)).alias("event_id"),
        _event_name(n).alias("event_name"),
        ts.alias("event_timestamp"),
        ingested.alias("ingested_at"),
        F.concat(F.lit("anon_"), F.lpad(F.col("user_id").cast("string"), 8, "0")).alias("anonymous_id"),
        F.when(m25 == 4, F.concat(F.lit("bot_"), pad_n))
         .otherwise(F.unix_seconds(F.date_trunc("day", ts)).cast("string")).alias("session_id"),
        F.lit(None).cast("string").alias("user_id"),
        F.struct(url.alias("url"), F.regexp_extract(url, PATH_PATTERN, 1).alias("path"),
                 F.lit(None).cast("string").alias("title"),
                 _pick(ref_idx, REFERRERS).alias("referrer")).alias("page"),
        F.struct(src.alias("source"), med.alias("medium"), camp.alias("campaign"),
                 F.lit(None).cast("string").alias("content"), F.lit(None).cast("string").alias("term"),
                 F.when(F.pmod(n, F.lit(3)) == 0, F.lit("first_touch"))
                  .otherwise(F.lit("last_touch")).alias("attribution")).alias("campaign"),
        F.struct(F.lit(DEVICE[0]).alias("platform"), F.lit(DEVICE[1]).alias("user_agent"),
                 F.lit(DEVICE[2]).alias("language"), F.lit(DEVICE[3]).cast("long").alias("screen_width"),
                 F.lit(DEVICE[4]).cast("long").alias("screen_height")).alias("device"),
        F.when(F.pmod(n, F.lit(41)) == 5, F.concat(F.lit('{"gclid":"g'), n.cast("string"), F.lit('"}')))
         .alias("params"),
        *([n.alias("bridge_n"), F.col("copy")] if keep_keys else []),
    )
    return out.withColumn("dt", F.to_date("ingested_at")).withColumn("event_date", F.to_date("event_timestamp"))


def _sql_pick(index: str, values) -> str:
    parts = []
    for i, v in enumerate(values):
        val = "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
        parts.append(f"WHEN {i} THEN {val}")
    return f"CAST(CASE {index} {' '.join(parts)} END AS VARCHAR)"


def _bridge_sql() -> str:
    url_cases = " ".join(f"WHEN n % 97 = {k} THEN '{u}'" for k, u in SPECIAL_URLS.items())
    ad_cases = " ".join(f"WHEN {k} THEN '{u}'" for k, u in AD_URLS.items())
    url = f"CASE WHEN n % 25 = 4 THEN '{ROBOT_URL}' {url_cases} ELSE page_url END"
    return f"""
bridge_src AS (
    SELECT e.event_id AS n, CAST(e.ts AS TIMESTAMP) AS ts, e.user_id AS uid, e.event_type,
           e.props, p.url AS page_url
    FROM events e
    LEFT JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)
),
bridge_rows AS (
    SELECT b.*, c.copy, {url} AS url
    FROM bridge_src b, (VALUES (0), (1)) c(copy)
    WHERE c.copy = 0 OR b.n % 20 = 0
),
bridge_typed AS (
    SELECT
        '0' AS schema_version,
        CASE WHEN n % 10 = 3 THEN NULL ELSE 'evt_' || lpad(CAST(n AS VARCHAR), 10, '0') END AS event_id,
        CASE WHEN n % 25 = 4 OR event_type = 'view' THEN 'page_view' ELSE event_type END AS event_name,
        ts AS event_timestamp,
        CASE WHEN n % 50 = 7 THEN ts + INTERVAL 2 DAY
             WHEN n % 50 = 8 THEN ts - INTERVAL 2 DAY
             WHEN n % 50 = 9 THEN ts + INTERVAL 10 MINUTE
             WHEN n % 50 = 10 THEN ts - INTERVAL 10 MINUTE
             ELSE ts + INTERVAL 1 SECOND END + to_seconds(copy * 9) AS ingested_at,
        'anon_' || lpad(CAST(uid AS VARCHAR), 8, '0') AS anonymous_id,
        CASE WHEN n % 25 = 4 THEN 'bot_' || lpad(CAST(n AS VARCHAR), 10, '0')
             ELSE CAST(CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS VARCHAR) END AS session_id,
        CAST(NULL AS VARCHAR) AS user_id,
        {{'url': url,
          'path': regexp_extract(url, '{PATH_PATTERN}', 1),
          'title': CAST(NULL AS VARCHAR),
          'referrer': {_sql_pick('(n // 32) % 8', REFERRERS)}}} AS page,
        {{'source': {_sql_pick('n % 32', [c[0] for c in CAMPAIGNS])},
          'medium': {_sql_pick('n % 32', [c[1] for c in CAMPAIGNS])},
          'campaign': {_sql_pick('n % 32', [c[2] for c in CAMPAIGNS])},
          'content': CAST(NULL AS VARCHAR), 'term': CAST(NULL AS VARCHAR),
          'attribution': CASE WHEN n % 3 = 0 THEN 'first_touch' ELSE 'last_touch' END}} AS campaign,
        {{'platform': '{DEVICE[0]}', 'user_agent': '{DEVICE[1]}', 'language': '{DEVICE[2]}',
          'screen_width': CAST({DEVICE[3]} AS BIGINT), 'screen_height': CAST({DEVICE[4]} AS BIGINT)}} AS device,
        CASE WHEN n % 41 = 5 THEN '{{"gclid":"g' || CAST(n AS VARCHAR) || '"}}' END AS params,
        n AS bridge_n, copy
    FROM bridge_rows
),
bridge_hits AS (
    SELECT 'anon_' || lpad(CAST(uid AS VARCHAR), 8, '0') AS anonymous_id,
           CASE WHEN n % 10 <> 3 THEN 'evt_' || lpad(CAST(n AS VARCHAR), 10, '0') END AS event_id, ts,
           CASE WHEN n % 30 = 2 THEN upper(nm) ELSE nm END AS event_name,
           CASE n % 23 {ad_cases} ELSE url END AS url, props
    FROM (SELECT *, CASE WHEN n % 25 = 4 OR event_type = 'view' THEN 'page_view' ELSE event_type END AS nm
          FROM bridge_rows)
),
contract_events AS (
    SELECT * EXCLUDE (bridge_n, copy), CAST(ingested_at AS DATE) AS dt,
           CAST(event_timestamp AS DATE) AS event_date
    FROM bridge_typed
)"""


BRIDGE_SQL = _bridge_sql()
