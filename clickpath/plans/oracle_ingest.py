"""DuckDB oracle for the ingest queries (B1-B8), generated from the same rule table as the
Spark validator.  Deep redaction is unrolled to a fixed depth here (the corpus nests at
most two levels); the Spark job itself recurses without a limit."""

from __future__ import annotations

from clickpath.config import REDACTED
from clickpath.functions.redaction import RAW_SECRET_PATTERN, SECRET_KEY_PATTERN
from clickpath.operators import ingest as I
from clickpath.sources.bodies import BAD_BASE64, BODIES_SQL

SEP = "chr(1)"
DEPTH = 3


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _secret(k: str) -> str:
    return f"regexp_matches(regexp_replace(lower({k}), '[^a-z0-9]', '', 'g'), {_q(SECRET_KEY_PATTERN)})"


def _empty(v: str) -> str:
    return f"(json_type({v}) = 'NULL' OR CAST({v} AS VARCHAR) IN ('\"\"', '{{}}', '[]'))"


def redact_sql(x: str, depth: int = DEPTH) -> str:
    """Deep redaction of a JSON value, unrolled ``depth`` levels; returns compact JSON text."""
    if depth == 0:
        return f"CAST({x} AS VARCHAR)"
    k, a = f"k{depth}", f"a{depth}"
    sub = f"json_extract({x}, '$.\"' || {k} || '\"')"
    obj = (f"'{{' || array_to_string(list_transform(json_keys({x}), lambda {k}: '\"' || {k} || '\":' || "
           f"CASE WHEN {_secret(k)} AND NOT {_empty(sub)} THEN '\"{REDACTED}\"' "
           f"ELSE {redact_sql(sub, depth - 1)} END), ',') || '}}'")
    arr = (f"'[' || array_to_string(list_transform(json_extract({x}, '$[*]'), lambda {a}: "
           f"{redact_sql(a, depth - 1)}), ',') || ']'")
    return f"(CASE json_type({x}) WHEN 'OBJECT' THEN {obj} WHEN 'ARRAY' THEN {arr} ELSE CAST({x} AS VARCHAR) END)"


def redact_text_sql(x: str) -> str:
    return f"regexp_replace({x}, {_q(RAW_SECRET_PATTERN)}, '\\1\\2{REDACTED}', 'g')"


def _ctype(v: str) -> str:
    """Contract type of a JSON value (NULL when absent)."""
    return (f"(CASE json_type({v}) WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' "
            f"WHEN 'NULL' THEN 'null' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' "
            f"WHEN 'BIGINT' THEN 'integer' WHEN 'UBIGINT' THEN 'integer' "
            f"WHEN 'DOUBLE' THEN CASE WHEN CAST({v} AS DOUBLE) = floor(CAST({v} AS DOUBLE)) THEN 'integer' "
            f"ELSE 'number' END END)")


def _type_ok(t: str, allowed: list[str]) -> str:
    types = list(allowed) + (["integer"] if "number" in allowed else [])
    return f"({t} IN ({', '.join(_q(x) for x in types)}))"


def _repr(v: str) -> str:
    return f"(CASE WHEN json_type({v}) = 'VARCHAR' THEN '''' || json_extract_string({v}, '$') || '''' ELSE CAST({v} AS VARCHAR) END)"


def _err(path: str, cond: str, msg: str) -> str:
    loc = path.replace(".", "/") if path else "<root>"
    key = " || ".join(_q(p) for p in path.split(".")) if path else "''"
    if "." in path:
        key = f" || {SEP} || ".join(_q(p) for p in path.split("."))
    return f"CASE WHEN {cond} THEN {{'k': {key}, 'm': {_q(loc + ': ')} || {msg}}} END"


def _unexpected(obj: str, path: str, allowed: list[str]) -> str:
    extra = f"list_filter(json_keys({obj}), lambda x: x NOT IN ({', '.join(_q(a) for a in allowed)}))"
    msg = (f"'Additional properties are not allowed (' || array_to_string(list_transform({extra}, "
           f"lambda x: '''' || x || ''''), ', ') || CASE WHEN len({extra}) = 1 THEN ' was' ELSE ' were' END "
           f"|| ' unexpected)'")
    return _err(path, f"len({extra}) > 0", msg)


def errors_sql(elem: str, params: str) -> str:
    """Sorted error list for an object element (stamped; params redacted)."""
    errs = []
    keys = f"list_append(json_keys({elem}), 'ingested_at')"
    for f in I.REQUIRED:
        errs.append(_err("", f"NOT list_contains({keys}, {_q(f)})", _q(f"'{f}' is a required property")))
    errs.append(_unexpected(elem, "", I.ROOT_FIELDS))
    for path, allowed, checks in I.FIELD_RULES:
        if path == "ingested_at":
            continue  # stamped by the server: always a valid date-time
        v = params if path == "params" else f"json_extract({elem}, {_q('$.' + path)})"
        t = _ctype(v)
        present = f"({v} IS NOT NULL)"
        errs.append(_err(path, f"{present} AND NOT {_type_ok(t, allowed)}",
                         f"{_repr(v)} || {_q(' is not of type ' + I._types_text(allowed))}"))
        is_str = f"({present} AND {t} = 'string')"
        s = f"json_extract_string({v}, '$')"
        if "const" in checks:
            errs.append(_err(path, f"{present} AND NOT coalesce({is_str} AND {s} = {_q(checks['const'])}, false)",
                             _q(f"'{checks['const']}' was expected")))
        if "min" in checks:
            errs.append(_err(path, f"{is_str} AND length({s}) < {checks['min']}", f"{_repr(v)} || ' is too short'"))
        if "max" in checks:
            errs.append(_err(path, f"{is_str} AND length({s}) > {checks['max']}", f"{_repr(v)} || ' is too long'"))
        if "pattern" in checks:
            errs.append(_err(path, f"{is_str} AND NOT regexp_matches({s}, {_q(checks['pattern'])})",
                             f"{_repr(v)} || {_q(' does not match ' + repr(checks['pattern']))}"))
        if "date_time" in checks:
            ok = f"(regexp_matches({s}, {_q(I.DATE_TIME_PATTERN)}) AND try_cast({s} AS TIMESTAMPTZ) IS NOT NULL)"
            errs.append(_err(path, f"{is_str} AND NOT coalesce({ok}, false)", f"{_repr(v)} || ' is not a ''date-time'''"))
        if "enum" in checks:
            errs.append(_err(path, f"{is_str} AND {s} NOT IN ({', '.join(_q(x) for x in checks['enum'])})",
                             f"{_repr(v)} || {_q(' is not one of ' + I._py_list(checks['enum']))}"))
        if path in I.CLOSED_OBJECTS:
            errs.append(f"CASE WHEN {present} AND {t} = 'object' THEN {_unexpected(v, path, I.CLOSED_OBJECTS[path])} END")
        if "max_properties" in checks:
            errs.append(_err(path, f"{present} AND {t} = 'object' AND len(json_keys({v})) > {checks['max_properties']}",
                             f"CAST({v} AS VARCHAR) || ' has too many properties'"))
    pv = f"json_extract({params}, '$.\"' || pk || '\"')"
    per_key = (f"coalesce(list_transform(list_filter(json_keys({params}), lambda pk: NOT "
               f"{_type_ok(_ctype(pv), I.PARAM_VALUE_TYPES)}), lambda pk: {{'k': 'params' || {SEP} || pk, "
               f"'m': 'params/' || pk || ': ' || {_repr(pv)} || "
               f"{_q(' is not of type ' + I._types_text(I.PARAM_VALUE_TYPES))}}}), [])")
    listed = f"list_concat(list_filter([{', '.join(errs)}], lambda e: e IS NOT NULL), {per_key})"
    return f"list_transform(list_sort({listed}), lambda e: e.m)"


def _py_type(elem: str) -> str:
    return (f"CASE json_type({elem}) WHEN 'OBJECT' THEN 'dict' WHEN 'ARRAY' THEN 'list' WHEN 'VARCHAR' THEN 'str' "
            f"WHEN 'BOOLEAN' THEN 'bool' WHEN 'NULL' THEN 'NoneType' WHEN 'DOUBLE' THEN 'float' ELSE 'int' END")


def ingest_ctes() -> str:
    std = "translate(e, '-_', '+/')"
    decoded_text = f"try(decode(from_base64({std} || repeat('=', (4 - length({std}) % 4) % 4))))"
    b64url = "rtrim(translate(to_base64(encode(body)), '+/', '-_'), '=')"
    return BODIES_SQL + f""",
requests AS (
    SELECT received_at, pixel, body,
        CASE WHEN pixel THEN (CASE WHEN bridge_n % 30 = 0 THEN '' WHEN bridge_n % 30 = 20 THEN '{BAD_BASE64}'
                                   ELSE {b64url} END) END AS e
    FROM corpus
),
pixel_text AS (
    SELECT *, CASE WHEN pixel AND e <> '' THEN {decoded_text} END AS ptext FROM requests
),
decoded AS (
    SELECT received_at,
        CASE WHEN NOT pixel THEN body
             WHEN e = '' OR ptext IS NULL OR NOT json_valid(ptext) THEN e ELSE ptext END AS body,
        CASE WHEN NOT pixel THEN NULL
             WHEN e = '' THEN {_q(I.PIXEL_EMPTY_MESSAGE)}
             WHEN ptext IS NULL OR NOT json_valid(ptext) THEN {_q(I.PIXEL_BAD_MESSAGE)} END AS decode_error
    FROM pixel_text
),
elem_lists AS (
    SELECT *, CASE WHEN decode_error IS NOT NULL OR NOT coalesce(json_valid(body), false) THEN [NULL::JSON]
                   WHEN json_type(body) = 'ARRAY' THEN json_extract(body, '$[*]')
                   ELSE [body::JSON] END AS elems
    FROM decoded
),
elements AS (
    SELECT received_at, body, decode_error, unnest(elems) AS elem FROM elem_lists
),
redacted AS (
    SELECT *, make_timestamp((epoch_us(received_at) // 1000) * 1000) AS ingested_at,
        json_type(elem) = 'OBJECT' AS is_obj,
        CASE WHEN json_type(elem) = 'OBJECT' AND json_extract(elem, '$.params') IS NOT NULL
             THEN {redact_sql("json_extract(elem, '$.params')")} END AS params
    FROM elements
),
processed AS (
    SELECT ingested_at, CAST(ingested_at AS DATE) AS dt, elem, params, is_obj,
        CASE WHEN decode_error IS NOT NULL THEN [decode_error]
             WHEN elem IS NULL THEN [{_q(I.UNPARSEABLE_MESSAGE)}]
             WHEN NOT is_obj THEN [{_q(I.NOT_OBJECT_MESSAGE)} || {_py_type('elem')}]
             ELSE {errors_sql('elem', 'CAST(params AS JSON)')} END AS errors,
        CASE WHEN is_obj THEN
                 CASE WHEN params IS NULL THEN CAST(elem AS VARCHAR)
                      ELSE replace(CAST(elem AS VARCHAR), '"params":' || CAST(json_extract(elem, '$.params') AS VARCHAR),
                                   '"params":' || params) END
             WHEN elem IS NOT NULL THEN
                 CASE WHEN json_type(elem) = 'VARCHAR' THEN '"' || {redact_text_sql("json_extract_string(elem, '$')")} || '"'
                      ELSE {redact_sql('elem')} END
        END AS payload,
        CASE WHEN elem IS NULL THEN {redact_text_sql("coalesce(body, '')")} END AS payload_raw
    FROM redacted
)"""


FORK_COUNTS = ("SELECT dt, count(*) AS received, count(*) FILTER (WHERE len(errors) = 0) AS accepted, "
               "count(*) FILTER (WHERE len(errors) > 0) AS rejected FROM processed GROUP BY dt")
ERRORS = "SELECT error, count(*) AS elements FROM (SELECT unnest(errors) AS error FROM processed) GROUP BY error"
BAD_ROWS = ("SELECT ingested_at, dt, array_to_string(errors, ' | ') AS errors_text, payload, payload_raw "
            "FROM processed WHERE len(errors) > 0")
_TEXTS = {"page": ["url", "path", "title", "referrer"], "campaign": ["source", "medium", "campaign", "content", "term", "attribution"],
          "device": ["platform", "user_agent", "language"]}
GOOD_EVENTS = (
    "SELECT " + ", ".join(f"json_extract_string(elem, '$.{c}') AS {c}" for c in ("schema_version", "event_id", "event_name", "anonymous_id", "session_id", "user_id"))
    + ", timezone('UTC', CAST(json_extract_string(elem, '$.event_timestamp') AS TIMESTAMPTZ)) AS event_timestamp, ingested_at, "
    + ", ".join(f"json_extract_string(elem, '$.{o}.{c}') AS {o}_{c}" for o, cs in _TEXTS.items() for c in cs)
    + ", " + ", ".join(f"CAST(json_extract(elem, '$.device.{c}') AS BIGINT) AS device_{c}" for c in ("screen_width", "screen_height"))
    + ", params, dt FROM processed WHERE len(errors) = 0")
