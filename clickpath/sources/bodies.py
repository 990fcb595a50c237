"""Raw request corpus for the ingest jobs (B1-B8), derived from the bridge rows.

Every bridge delivery becomes one request whose body is the event serialised as compact
JSON (keys in sorted order).  Deterministic defects by ``n % 30`` exercise every branch:

   1 session_id missing          2 upper-case event_name      3 unknown root key
   4 body truncated to 60 chars  5 secret params (flat)        6 nested param holding a secret
   7 event_id of 2 chars         8 array body [event, 42, "str apikey=...", null]
   9 schema_version "1"         10 unparseable timestamp     11 anonymous_id of 3 chars
  12 attribution outside enum   13 platform outside enum     14 unknown key in page
  15 screen_width not integer   16 26 params                 17 empty array body
  18 client-supplied ingested_at (overwritten)               19 body is JSON null
  21 event followed by markup   22 two events in one body       23 user_id given twice (last counts)
  24 truncated, then over 5,000 characters and a secret

Every 7th request (n % 7 = 0) arrives as a pixel ``GET ?e=<base64url>`` instead; among
those, n % 30 = 0 sends an empty ``e`` and n % 30 = 20 an undecodable one.  The request
arrives at the bridge's ``ingested_at``.  ``BODIES_SQL`` is the same corpus as DuckDB CTEs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath.sources.bridge import DEVICE, bridge_events

# ---- fixed values of the corpus --------------------------------------------------------------
TRUNCATE_AT = 60
PIXEL_EVERY = 7
CLIENT_INGESTED_AT = "1999-01-01T00:00:00Z"
SECRET_PARAMS = ('{"auth_token":"tok', '","empty_secret":"","plan":"pro","x-api-key":"k', '"}')
NESTED_PARAMS = ('{"auth":{"password":"p', '"},"plan":"pro"}')
MANY_PARAMS = "{" + ",".join(f'"p{i:02d}":{i}' for i in range(26)) + "}"
BAD_BASE64 = "not*base64"
TRAILING = " <html>"
TWICE = ('{"user_id":"first_user",', '"user_id":"last_user",')
LONG_TAIL = "z" * 5000 + " password=tail"
# ----------------------------------------------------------------------------------------------


def _jstr(c: Column) -> Column:
    esc = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), esc, F.lit('"'))


def _jval(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("null")).otherwise(_jstr(c))


def bridge_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, body, e, received_at, bridge_n): kind 'post' carries ``body``, 'pixel' ``e``."""
    ev = bridge_events(spark, sf_dir, keep_keys=True)
    n = F.col("bridge_n")
    m = F.pmod(n, F.lit(30))
    ns = n.cast("string")

    def opt(cond: Column, text: Column) -> Column:
        return F.when(cond, text).otherwise(F.lit(""))

    ts_text = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    campaign = F.concat(
        F.lit('{"attribution":'), F.when(m == 12, F.lit('"middle_touch"')).otherwise(_jstr(F.col("campaign.attribution"))),
        F.lit(',"campaign":'), _jval(F.col("campaign.campaign")),
        F.lit(',"medium":'), _jval(F.col("campaign.medium")),
        F.lit(',"source":'), _jval(F.col("campaign.source")), F.lit("}"))
    device = F.concat(
        F.lit(f'{{"language":"{DEVICE[2]}","platform":'), F.when(m == 13, F.lit('"tv"')).otherwise(F.lit(f'"{DEVICE[0]}"')),
        F.lit(f',"screen_height":{DEVICE[4]},"screen_width":'),
        F.when(m == 15, F.lit('"wide"')).otherwise(F.lit(str(DEVICE[3]))),
        F.lit(f',"user_agent":"{DEVICE[1]}"}}'))
    page = F.concat(
        F.lit("{"), opt(m == 14, F.lit('"hash":"x",')),
        F.lit('"path":'), _jstr(F.col("page.path")), F.lit(',"referrer":'), _jval(F.col("page.referrer")),
        F.lit(',"url":'), _jstr(F.col("page.url")), F.lit("}"))
    params = (F.when(m == 5, F.concat(F.lit(SECRET_PARAMS[0]), ns, F.lit(SECRET_PARAMS[1]), ns, F.lit(SECRET_PARAMS[2])))
              .when(m == 6, F.concat(F.lit(NESTED_PARAMS[0]), ns, F.lit(NESTED_PARAMS[1])))
              .when(m == 16, F.lit(MANY_PARAMS))
              .otherwise(F.col("params")))
    event_id = F.when(m == 7, F.concat(F.lit('"e'), F.pmod(n, F.lit(10)).cast("string"), F.lit('"'))) \
        .otherwise(_jstr(F.col("event_id")))
    obj = F.concat(
        F.lit('{"anonymous_id":'), F.when(m == 11, F.lit('"abc"')).otherwise(_jstr(F.col("anonymous_id"))),
        F.lit(',"campaign":'), campaign,
        F.lit(',"device":'), device,
        opt(F.col("event_id").isNotNull(), F.concat(F.lit(',"event_id":'), event_id)),
        F.lit(',"event_name":'), _jstr(F.when(m == 2, F.upper("event_name")).otherwise(F.col("event_name"))),
        F.lit(',"event_timestamp":'), F.when(m == 10, F.lit('"not-a-time"')).otherwise(_jstr(ts_text)),
        opt(m == 3, F.lit(',"extra":1')),
        opt(m == 18, F.lit(f',"ingested_at":"{CLIENT_INGESTED_AT}"')),
        F.lit(',"page":'), page,
        opt(params.isNotNull(), F.concat(F.lit(',"params":'), F.coalesce(params, F.lit("")))),
        F.lit(',"schema_version":'), F.when(m == 9, F.lit('"1"')).otherwise(F.lit('"0"')),
        opt(m != 1, F.concat(F.lit(',"session_id":'), _jstr(F.col("session_id")))),
        F.lit("}"))
    ev, obj = ev.withColumn("_obj", obj), F.col("_obj")        # built once, used in several branches
    body = (F.when(m == 4, F.substring(obj, 1, TRUNCATE_AT))
            .when(m == 8, F.concat(F.lit("["), obj, F.lit(',42,"str apikey=abc'), ns, F.lit('",null]')))
            .when(m == 17, F.lit("[]"))
            .when(m == 19, F.lit("null"))
            .when(m == 21, F.concat(obj, F.lit(TRAILING)))
            .when(m == 22, F.concat(obj, F.lit(" "), obj))
            .when(m == 23, F.concat(F.lit("".join(TWICE)), F.substring(obj, 2, 1 << 30)))
            .when(m == 24, F.concat(F.substring(obj, 1, TRUNCATE_AT), F.lit(LONG_TAIL)))
            .otherwise(obj))
    pixel = F.pmod(n, F.lit(PIXEL_EVERY)) == 0
    # Spark's base64 is MIME-chunked (CRLF every 76 chars); a URL parameter has no breaks.
    b64 = F.regexp_replace(F.base64(F.encode(body, "UTF-8")), "[\r\n]", "")
    b64url = F.regexp_replace(F.translate(b64, "+/", "-_"), "=+$", "")
    e = F.when(m == 0, F.lit("")).when(m == 20, F.lit(BAD_BASE64)).otherwise(b64url)
    return ev.select(
        F.when(pixel, F.lit("pixel")).otherwise(F.lit("post")).alias("kind"),
        F.when(~pixel, body).alias("body"),
        F.when(pixel, e).alias("e"),
        F.col("ingested_at").alias("received_at"),
        n, F.col("copy"))


def bridge_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request bodies ready for ``ingest``: POST bodies plus decoded pixel requests (B2)."""
    from clickpath.operators.ingest import decode_pixel
    req = bridge_requests(spark, sf_dir)
    posts = req.where(F.col("kind") == "post").select("body", "received_at",
                                                       F.lit(None).cast("string").alias("decode_error"))
    pixels = decode_pixel(req.where(F.col("kind") == "pixel").select("e", "received_at"))
    return posts.unionByName(pixels)


def bridge_access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus' requests as a web server's combined log has them: pixels with their query, posts without their bodies."""
    r = bridge_requests(spark, sf_dir)
    pixel = F.col("kind") == "pixel"
    request = F.when(pixel, F.concat(F.lit("GET /collect?v=1&e="), F.url_encode("e"))).otherwise(F.lit("POST /collect"))
    at = F.date_format("received_at", "dd/MMM/yyyy:HH:mm:ss Z")
    return r.select(F.concat(F.lit("203.0.113.7 - - ["), at, F.lit('] "'), request, F.lit(' HTTP/1.1" 200 43 "-" "agent/1.0 (\\"x\\")"')).alias("value"))


def _sql_jstr(x: str) -> str:
    return f"""('"' || replace(replace({x}, '\\', '\\\\'), '"', '\\"') || '"')"""


def _sql_jval(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'null' ELSE {_sql_jstr(x)} END"


def _bodies_sql() -> str:
    m = "(bridge_n % 30)"
    ns = "CAST(bridge_n AS VARCHAR)"
    ts_text = "strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ')"
    campaign = (f"""'{{"attribution":' || CASE WHEN {m} = 12 THEN '"middle_touch"' ELSE {_sql_jstr('campaign.attribution')} END"""
                f""" || ',"campaign":' || {_sql_jval('campaign.campaign')} || ',"medium":' || {_sql_jval('campaign.medium')}"""
                f""" || ',"source":' || {_sql_jval('campaign.source')} || '}}'""")
    device = (f"""'{{"language":"{DEVICE[2]}","platform":' || CASE WHEN {m} = 13 THEN '"tv"' ELSE '"{DEVICE[0]}"' END"""
              f""" || ',"screen_height":{DEVICE[4]},"screen_width":' || CASE WHEN {m} = 15 THEN '"wide"' ELSE '{DEVICE[3]}' END"""
              f""" || ',"user_agent":"{DEVICE[1]}"}}'""")
    page = (f"""'{{' || CASE WHEN {m} = 14 THEN '"hash":"x",' ELSE '' END || '"path":' || {_sql_jstr('page.path')}"""
            f""" || ',"referrer":' || {_sql_jval('page.referrer')} || ',"url":' || {_sql_jstr('page.url')} || '}}'""")
    params = (f"""CASE WHEN {m} = 5 THEN '{SECRET_PARAMS[0]}' || {ns} || '{SECRET_PARAMS[1]}' || {ns} || '{SECRET_PARAMS[2]}'"""
              f""" WHEN {m} = 6 THEN '{NESTED_PARAMS[0]}' || {ns} || '{NESTED_PARAMS[1]}'"""
              f""" WHEN {m} = 16 THEN '{MANY_PARAMS}' ELSE params END""")
    event_id = f"""CASE WHEN {m} = 7 THEN '"e' || CAST(bridge_n % 10 AS VARCHAR) || '"' ELSE {_sql_jstr('event_id')} END"""
    obj = (f"""'{{"anonymous_id":' || CASE WHEN {m} = 11 THEN '"abc"' ELSE {_sql_jstr('anonymous_id')} END"""
           f""" || ',"campaign":' || {campaign} || ',"device":' || {device}"""
           f""" || CASE WHEN event_id IS NOT NULL THEN ',"event_id":' || {event_id} ELSE '' END"""
           f""" || ',"event_name":' || {_sql_jstr(f"CASE WHEN {m} = 2 THEN upper(event_name) ELSE event_name END")}"""
           f""" || ',"event_timestamp":' || CASE WHEN {m} = 10 THEN '"not-a-time"' ELSE {_sql_jstr(ts_text)} END"""
           f""" || CASE WHEN {m} = 3 THEN ',"extra":1' ELSE '' END"""
           f""" || CASE WHEN {m} = 18 THEN ',"ingested_at":"{CLIENT_INGESTED_AT}"' ELSE '' END"""
           f""" || ',"page":' || {page}"""
           f""" || CASE WHEN ({params}) IS NOT NULL THEN ',"params":' || ({params}) ELSE '' END"""
           f""" || ',"schema_version":' || CASE WHEN {m} = 9 THEN '"1"' ELSE '"0"' END"""
           f""" || CASE WHEN {m} <> 1 THEN ',"session_id":' || {_sql_jstr('session_id')} ELSE '' END || '}}'""")
    return f"""
corpus_obj AS (
    SELECT bridge_n, copy, ingested_at AS received_at, {obj} AS obj FROM bridge_typed
),
corpus AS (
    SELECT bridge_n, copy, received_at,
        CASE WHEN {m} = 4 THEN substr(obj, 1, {TRUNCATE_AT})
             WHEN {m} = 8 THEN '[' || obj || ',42,"str apikey=abc' || {ns} || '",null]'
             WHEN {m} = 17 THEN '[]'
             WHEN {m} = 19 THEN 'null'
             WHEN {m} = 21 THEN obj || '{TRAILING}'
             WHEN {m} = 22 THEN obj || ' ' || obj
             WHEN {m} = 23 THEN '{{' || '{TWICE[1]}' || substr(obj, 2)
             WHEN {m} = 24 THEN substr(obj, 1, {TRUNCATE_AT}) || '{LONG_TAIL}'
             ELSE obj END AS body,
        bridge_n % {PIXEL_EVERY} = 0 AS pixel
    FROM corpus_obj
)"""


BODIES_SQL = _bodies_sql()
