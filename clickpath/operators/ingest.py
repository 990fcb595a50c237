"""Ingest quality (B1-B9): raw request bodies -> redacted, stamped, validated good/bad rows.

Nothing is dropped: every element of every body lands in exactly one of the two outputs
(good + bad = received).  All of it is JVM-side (variant parsing, a rule table compiled
into one ``array`` expression) except the deep JSON redaction UDF, which only sees rows
whose text could hold a secret.

Input (``bodies``): ``body`` (request text), ``received_at`` (server arrival time - the
stamp), optional ``collector_instance``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath.functions.redaction import redact_text, with_redacted
from clickpath.operators.contract import (CLOSED_OBJECTS, DATE_TIME_PATTERN, FIELD_RULES, PARAM_VALUE_TYPES, REQUIRED,  # noqa: F401
                                          ROOT_FIELDS, SEP, TYPED, V0, Contract, _py_list, _types_text, surely_valid, with_contract_errors)
from clickpath.sources.schema import EVENT_SCHEMA
from clickpath.storage import stored

# ---- fixed values: messages and type names -----------------------------------------------------
NOT_OBJECT_MESSAGE = "event must be a JSON object, got "
UNPARSEABLE_MESSAGE = "body is not valid JSON"
PIXEL_EMPTY_MESSAGE = "GET /collect called without the `e` parameter"
PIXEL_BAD_MESSAGE = "`e` is not base64url-encoded JSON"
PY_TYPE_NAMES = [("OBJECT", "dict"), ("ARRAY", "list"), ("STRING", "str"), ("BOOLEAN", "bool"),
                 ("VOID", "NoneType"), ("DOUBLE", "float"), ("FLOAT", "float"), ("DECIMAL", "float")]
# -------------------------------------------------------------------------------------------------

def _get(v: Column, path: str) -> Column:
    return F.variant_get(v, "$." + path, "variant")


def _py_type_name(v: Column) -> Column:
    s = F.schema_of_variant(v)
    out = F.when(s.isin("TINYINT", "SMALLINT", "INT", "BIGINT"), "int")
    for prefix, name in PY_TYPE_NAMES:
        out = out.when(s.startswith(prefix), name)
    return out.otherwise("object")


END_MARK = "end of body"


def with_whole_json(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the JSON value that is all of ``text``; NULL if there is none, or anything follows it.

    The parser stops at the end of the first value.  As the first element of an array that a
    mark closes, the text must be exactly one value for the array to have two elements.
    The array is a column of its own, so each text is parsed once."""
    framed = F.try_parse_json(F.concat(F.lit("["), F.col(text), F.lit(f',"{END_MARK}"]')))
    df = df.withColumn("_framed", F.try_variant_get(framed, "$", "array<variant>"))
    mark = F.try_variant_get(F.get("_framed", F.lit(1)), "$", "string")
    whole = (F.size("_framed") == 2) & (mark == END_MARK)
    return df.withColumn(out, F.when(whole, F.get("_framed", F.lit(0)))).drop("_framed")


def allow_repeated_keys(spark: SparkSession) -> None:
    """Of an object's repeated keys the last counts, as in every JSON reader of the contract."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def small_methods(spark: SparkSession) -> None:
    """The JVM compiles no method over 8,000 bytes: a stage with one is run operator by operator,
    whose expressions Spark cuts into small methods, rather than interpreted row by row."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def decode_bodies(bodies: DataFrame) -> DataFrame:
    """B1: one row per event element.  An array body yields one row per element (an empty
    array yields none); an object one row; unparseable text one row with ``elem`` NULL."""
    b = bodies
    if "collector_instance" not in b.columns:
        b = b.withColumn("collector_instance", F.lit(None).cast("string"))
    if "decode_error" not in b.columns:
        b = b.withColumn("decode_error", F.lit(None).cast("string"))
    allow_repeated_keys(bodies.sparkSession)
    small_methods(bodies.sparkSession)
    b = with_whole_json(b, "body", "_parsed")
    parsed = F.col("_parsed")
    # Only an array reads as one: asking costs less than the schema text of a whole body.
    elems = (F.when(F.col("decode_error").isNotNull() | parsed.isNull(), F.array(F.lit(None).cast("variant")))
             .otherwise(F.coalesce(F.try_variant_get(parsed, "$", "array<variant>"), F.array(parsed))))
    return b.select("body", "received_at", "collector_instance", "decode_error",
                    F.posexplode(elems).alias("elem_pos", "elem"))


def decode_pixel(requests: DataFrame) -> DataFrame:
    """B2: ``GET /collect?e=<base64url JSON>`` -> body text, with padding restored.

    An empty ``e`` or one that does not decode to UTF-8 text becomes a bad row with a
    reason (the text after it is kept, redacted, as ``payload_raw``)."""
    allow_repeated_keys(requests.sparkSession)
    e = F.coalesce(F.col("e"), F.lit(""))
    std = F.translate(e, "-_", "+/")
    x = (requests.withColumn("_std", std)
         .withColumn("_text", F.expr("try_validate_utf8(cast(try_to_binary(concat(_std, "
                                     "repeat('=', (4 - length(_std) % 4) % 4)), 'base64') AS STRING))")))
    x = with_whole_json(x, "_text", "_whole")
    text = F.col("_text")
    reason = (F.when(e == "", F.lit(PIXEL_EMPTY_MESSAGE))
              .when(F.col("_whole").isNull(), F.lit(PIXEL_BAD_MESSAGE)))
    return x.select(
        F.when(reason.isNull(), text).otherwise(e).alias("body"),
        "received_at",
        *([F.col("collector_instance")] if "collector_instance" in requests.columns else []),
        reason.alias("decode_error"))


# Fixed: the common and the combined log format (host, identity, user, time, request, status, bytes, ...).
_LOG_LINE = r'^(\S+) (\S+) (\S+) \[([^\]]*)\] "([A-Z]+) ([^ "]*)(?: (HTTP/[0-9.]+))?" ([0-9]{3}) (\S+)(?: .*)?$'
_LOG_TIME = "dd/MMM/yyyy:HH:mm:ss Z"


def _decoded(text: Column) -> Column:
    """Form-decoded text: ``+`` is a space, ``%XX`` a byte; as it is where an escape is none."""
    return F.coalesce(F.try_url_decode(text), text)


def with_log_fields(lines: DataFrame, line: str = "value") -> DataFrame:
    """Add what an access-log line says: ``log_method``, ``log_path``, ``log_query``, ``log_at``
    (all NULL where the line, or its time, does not fit the format)."""
    def part(k: int) -> Column:
        return F.regexp_extract(F.col(line), _LOG_LINE, k)

    at = F.try_to_timestamp(part(4), F.lit(_LOG_TIME))
    fits = at.isNotNull() & (part(5) != "")
    target = part(6)
    return lines.withColumns({
        "log_method": F.when(fits, part(5)), "log_path": F.when(fits, _decoded(F.substring_index(target, "?", 1))),
        "log_query": F.when(fits, F.regexp_extract(target, r"^[^?]*\?([^#]*)", 1)), "log_at": F.when(fits, at)})


def log_pixels(lines: DataFrame, path: str = "/collect", line: str = "value") -> DataFrame:
    """The pixel requests (``GET <path>``) of access-log lines as ``(e, received_at)``.

    ``e`` is the last parameter of that name, form-decoded; without one it is empty.  The time of
    arrival is the log's.  Other requests are no events; lines that are no log lines are in
    :func:`log_rest`."""
    found = with_log_fields(lines, line).where((F.col("log_method") == "GET") & (F.col("log_path") == path))
    given = F.filter(F.split("log_query", "&"), lambda p: _decoded(F.substring_index(p, "=", 1)) == "e")
    last = F.try_element_at(given, F.lit(-1))
    value = F.when(F.contains(last, F.lit("=")), _decoded(F.regexp_extract(last, r"^[^=]*=(.*)$", 1)))
    return found.select(F.coalesce(value, F.lit("")).alias("e"), F.col("log_at").alias("received_at"))


def log_rest(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines that are not blank and no access-log lines: with the requests they make up the log."""
    return with_log_fields(lines, line).where(F.col("log_method").isNull() & (F.trim(line) != "")).select(line)


def stamp(received_at: Column) -> Column:
    """The server's ingest time, UTC, millisecond precision (overwrites the client's)."""
    return F.timestamp_millis(F.unix_millis(received_at))


def process(elements: DataFrame, versions: dict[str, Contract] | None = None) -> DataFrame:
    """B3-B6 on decoded elements: one row per element with ``errors`` (empty = good).

    ``versions`` are further contracts by the ``schema_version`` that chooses them (see
    :func:`clickpath.operators.contract.compile_schema`); all other events are judged by the
    fixed one.

    Columns: ingested_at, dt, collector_instance, elem_pos, errors, good, event (variant,
    stamped, params redacted), params (redacted JSON text), payload (post-redaction JSON
    text of what was received, for bad rows), payload_raw (redacted whole text of an
    unparseable body)."""
    e = F.col("elem")
    kind = F.schema_of_variant(e)
    x = elements.select("received_at", "collector_instance", "decode_error", "elem_pos", "elem", kind.alias("_kind"),
                        F.when(e.isNull(), F.coalesce("body", F.lit(""))).alias("_raw"))
    x = x.withColumn("_is_obj", e.isNotNull() & F.col("_kind").startswith("OBJECT"))
    # Deep redaction of params, or of a payload that is neither an object nor a text, in one pass;
    # what has nothing to redact is NULL, so nothing is rendered and searched for it.
    x = x.withColumn("_given", F.when(F.col("_is_obj"), F.to_json(_get(e, "params")))
                     .otherwise(F.to_json(F.when(F.col("_kind") != "STRING", e))))
    x = with_redacted(x, "_given", "_redacted")
    x = x.withColumns({"ingested_at": stamp(F.col("received_at")), "params": F.when(F.col("_is_obj"), F.col("_redacted"))})
    # The rule table sees only rows that the cheap test cannot clear.
    x = x.withColumn("_typed", F.when(F.col("_is_obj"), F.try_variant_get(e, "$", TYPED)))
    x = x.withColumn("_clear", F.col("_is_obj") & surely_valid("elem", "_kind", "_typed"))
    x = x.withColumn("_doubtful", F.when(F.col("_is_obj") & ~F.col("_clear"), e))
    x = x.withColumn("_pvar", F.when(F.col("_doubtful").isNotNull(), F.try_parse_json(F.col("params"))))
    fields = F.try_variant_get(e, "$", "map<string,variant>")
    version = F.try_variant_get(F.col("_doubtful"), "$.schema_version", "string")
    others = list(versions or {})
    if others:
        x = x.withColumn("_version", F.when(version.isin(others), version))
        ours = F.col("_version").isNull()
        x = x.withColumns({"_own": F.when(ours, F.col("_doubtful")), **{f"_event{k}": F.when(F.col("_version") == v, F.col("_doubtful")) for k, v in enumerate(others)}})
    x = with_contract_errors(x, "_own" if others else "_doubtful", "_pvar", "_contract_errors")
    for k, v in enumerate(others):
        x = with_contract_errors(x, f"_event{k}", "_pvar", f"_errors{k}", versions[v])
        x = x.withColumn("_contract_errors", F.when(F.col("_version") == v, F.col(f"_errors{k}")).otherwise(F.col("_contract_errors")))
    non_obj_payload = F.when(F.col("_kind") == "STRING", F.regexp_extract(F.to_json(F.array(redact_text(F.try_variant_get(e, "$", "string")))),
                                                                          r"^\[(.*)\]$", 1)).otherwise(F.col("_redacted"))
    errors = (F.when(F.col("decode_error").isNotNull(), F.array(F.col("decode_error")))
              .when(e.isNull(), F.array(F.lit(UNPARSEABLE_MESSAGE)))
              .when(~F.col("_is_obj"), F.array(F.concat(F.lit(NOT_OBJECT_MESSAGE), _py_type_name(e))))
              .when(F.col("_clear"), F.array().cast("array<string>"))
              .otherwise(F.col("_contract_errors")))
    # Optimisation barrier: a filter on ``good`` / ``errors`` (or the one Catalyst infers
    # from exploding ``errors``) would otherwise be pushed below this projection with the
    # whole rule table substituted into it - evaluated twice and too large for codegen.
    # A non-deterministic guard (always true) stops predicate pushdown at this projection;
    # results are unaffected.
    x = x.select("*", F.when(F.spark_partition_id() >= 0, errors).alias("errors"))
    good = F.size("errors") == 0
    # B7 bad payload: the received object with params redacted (as stored before the stamp);
    # rendered only for rows that are actually bad.
    empty = F.create_map().cast("map<string,variant>")
    red_params = F.when(F.col("_pvar").isNotNull(),
                        F.map_from_arrays(F.array(F.lit("params")), F.array(F.col("_pvar"))))
    redacted = F.to_json(F.to_variant_object(F.map_concat(
        F.map_filter(fields, lambda k, v: k != "params"), F.coalesce(red_params, empty))))
    # The object is put together anew only where redaction changed something in it.
    same = F.col("params").isNull() | (F.col("params") == F.col("_given"))
    as_received = F.when(same, F.to_json(e)).otherwise(redacted)
    return x.select(
        "ingested_at", F.to_date("ingested_at").alias("dt"), "collector_instance", "elem_pos", "errors",
        good.alias("good"), F.when(F.col("_is_obj"), e).alias("event"), "params",
        F.when(good, F.lit(None).cast("string")).when(F.col("_is_obj"), as_received)
         .when(e.isNotNull(), non_obj_payload).alias("payload"),
        redact_text(F.col("_raw")).alias("payload_raw"),
    )


def good_events(processed: DataFrame) -> DataFrame:
    """B7 good fork: typed contract rows (EVENT_SCHEMA + dt): the received fields, the
    redacted params and the server's ``ingested_at``."""
    v = F.col("event")
    cols = []
    for f in EVENT_SCHEMA.fields:
        if f.name == "params":
            cols.append(F.col("params"))
        elif f.name == "ingested_at":
            cols.append(F.col("ingested_at"))
        elif f.name == "event_timestamp":
            cols.append(F.try_to_timestamp(F.try_variant_get(v, "$.event_timestamp", "string")).alias(f.name))
        else:
            cols.append(F.try_variant_get(v, "$." + f.name, f.dataType.simpleString()).alias(f.name))
    return processed.where("good").select(*cols, "dt")


def bad_rows(processed: DataFrame) -> DataFrame:
    """B7 bad fork: errors plus the post-redaction payload (or raw text)."""
    return processed.where(~F.col("good")).select("ingested_at", "collector_instance", "errors", "payload",
                                                   "payload_raw", "dt")


def fork_counts(processed: DataFrame) -> DataFrame:
    """Accepted / rejected per ingest date."""
    return processed.groupBy("dt").agg(F.count(F.lit(1)).alias("received"),
                                       F.count_if(F.col("good")).alias("accepted"),
                                       F.count_if(~F.col("good")).alias("rejected"))


def ingest(bodies: DataFrame, versions: dict[str, Contract] | None = None) -> DataFrame:
    """B1-B6 in one pass over request bodies; ``versions`` as in :func:`process`."""
    return process(decode_bodies(bodies), versions)


REPLAY_KEY = ["anonymous_id", "session_id", "event_name", "event_timestamp", "ingested_at"]


def replay_bad(bad: DataFrame, known: DataFrame | None = None, versions: dict[str, Contract] | None = None) -> DataFrame:
    """Re-validate stored bad rows after a fix; rows that now pass come back as good
    contract rows.  A fix may be a further version of the contract (``versions`` as in
    :func:`process`) that the rows were sent for before it was known.

    A row's payload is the post-redaction object as received, or the raw text that no parser
    took then.  It is re-stamped with the original ``ingested_at`` so ``dt`` does not move.
    ``known`` is the good table: rows whose id it has, or that have no id and equal one of
    its rows in ``REPLAY_KEY``, are left out, so a second replay adds nothing."""
    bodies = (bad.select(F.coalesce("payload", "payload_raw").alias("body"), F.col("ingested_at").alias("received_at"), "collector_instance")
              .where(F.col("body").isNotNull()))
    fixed = good_events(ingest(bodies, versions))
    if known is None:
        return fixed
    fixed = stored(fixed, "replayed")          # read by both joins, judged once
    missing = F.col("event_id").isNull()
    # Of compressed lines Spark knows the files' size alone: the known rows must not go to the driver.
    with_id = fixed.where(~missing).join(known.where(~missing).select("event_id").hint("merge"), "event_id", "left_anti")
    others = known.where(missing).select(*[F.col(c).alias(f"_{c}") for c in REPLAY_KEY])
    same = None
    for c in REPLAY_KEY:
        equal = F.col(c).eqNullSafe(F.col(f"_{c}"))
        same = equal if same is None else same & equal
    return with_id.select(*fixed.columns).unionByName(fixed.where(missing).join(others.hint("merge"), same, "left_anti"))
