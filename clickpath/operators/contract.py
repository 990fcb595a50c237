"""The event contract (B6) as a rule table, compiled into SQL text that Spark analyses once.

:data:`V0` is the table of the fixed contract; :func:`compile_schema` makes one from a JSON
Schema, so that further versions of the contract are data.  The messages follow the usual JSON
Schema validator's.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpath.config import MAX_PARAMS
from clickpath.sources.schema import (ATTRIBUTION_VALUES, CAMPAIGN_FIELD_MAX_LEN, EVENT_NAME_PATTERN, ID_MAX_LEN, ID_MIN_LEN,
                                      PLATFORM_VALUES, SCHEMA_VERSION, USER_ID_MAX_LEN)

# ---- fixed values: the event contract v0 as a rule table ----------------------------------
# (path, allowed JSON types, extra checks).  Types: string, null, object, integer, number, boolean.
ROOT_FIELDS = ["schema_version", "event_id", "event_name", "event_timestamp", "ingested_at",
               "anonymous_id", "session_id", "user_id", "page", "campaign", "device", "params"]
REQUIRED = ["schema_version", "event_name", "event_timestamp", "anonymous_id", "session_id"]
CLOSED_OBJECTS = {
    "page": ["url", "path", "title", "referrer"],
    "campaign": ["source", "medium", "campaign", "content", "term", "attribution"],
    "device": ["platform", "user_agent", "language", "screen_width", "screen_height"],
}
FIELD_RULES = [
    ("schema_version", ["string"], {"const": SCHEMA_VERSION}),
    ("event_id", ["string"], {"min": ID_MIN_LEN, "max": ID_MAX_LEN}),
    ("event_name", ["string"], {"pattern": EVENT_NAME_PATTERN}),
    ("event_timestamp", ["string"], {"date_time": True}),
    ("ingested_at", ["string"], {"date_time": True}),
    ("anonymous_id", ["string"], {"min": ID_MIN_LEN, "max": ID_MAX_LEN}),
    ("session_id", ["string"], {"min": ID_MIN_LEN, "max": ID_MAX_LEN}),
    ("user_id", ["string", "null"], {"max": USER_ID_MAX_LEN}),
    ("page", ["object"], {}),
    ("page.url", ["string"], {}),
    ("page.path", ["string"], {}),
    ("page.title", ["string"], {}),
    ("page.referrer", ["string", "null"], {}),
    ("campaign", ["object"], {}),
    ("campaign.source", ["string", "null"], {"max": CAMPAIGN_FIELD_MAX_LEN}),
    ("campaign.medium", ["string", "null"], {"max": CAMPAIGN_FIELD_MAX_LEN}),
    ("campaign.campaign", ["string", "null"], {"max": CAMPAIGN_FIELD_MAX_LEN}),
    ("campaign.content", ["string", "null"], {"max": CAMPAIGN_FIELD_MAX_LEN}),
    ("campaign.term", ["string", "null"], {"max": CAMPAIGN_FIELD_MAX_LEN}),
    ("campaign.attribution", ["string"], {"enum": ATTRIBUTION_VALUES}),
    ("device", ["object"], {}),
    ("device.platform", ["string"], {"enum": PLATFORM_VALUES}),
    ("device.user_agent", ["string", "null"], {}),
    ("device.language", ["string", "null"], {}),
    ("device.screen_width", ["integer", "null"], {}),
    ("device.screen_height", ["integer", "null"], {}),
    ("params", ["object"], {"max_properties": MAX_PARAMS}),
]
PARAM_VALUE_TYPES = ["string", "number", "boolean", "null"]
# RFC 3339 / ISO-8601 shapes a browser emits; the value must also parse as a timestamp.
DATE_TIME_PATTERN = (r"^\d{4}-\d{2}-\d{2}([Tt ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?"
                     r"([Zz]|[+-]\d{2}(:?\d{2})?)?)?\z")
# -------------------------------------------------------------------------------------------------

SEP = "\u0001"  # path-component separator for sorting errors like Python sorts path lists
#: The object whose values are free but for their types, and the field the server stamps itself.
FREE, STAMPED = "params", "ingested_at"


@dataclass(frozen=True)
class Contract:
    """Allowed and required fields, closed objects, and (path, JSON types, checks) of every field."""

    root_fields: list[str]
    required: list[str]
    closed_objects: dict[str, list[str]]
    field_rules: list[tuple[str, list[str], dict]]
    param_types: list[str]


V0 = Contract(ROOT_FIELDS, REQUIRED, CLOSED_OBJECTS, FIELD_RULES, PARAM_VALUE_TYPES)

_CHECKS = {"const": "const", "minLength": "min", "maxLength": "max", "pattern": "pattern", "enum": "enum", "maxProperties": "max_properties"}
_PLAIN = {"$schema", "$id", "title", "description", "examples", "default", "$comment"}


def _rule(path: str, given: dict) -> tuple[str, list[str], dict]:
    kinds = given.get("type", "object" if "properties" in given else None)
    known = given.get("const") if kinds is None else None
    if kinds is None and not isinstance(known, str) and not all(isinstance(x, str) for x in given.get("enum", [0])):
        raise ValueError(f"{path}: a type is needed")
    allowed = ["string"] if kinds is None else [kinds] if isinstance(kinds, str) else list(kinds)
    checks = {_CHECKS[k]: v for k, v in given.items() if k in _CHECKS}
    if "format" in given:
        if given["format"] != "date-time":
            raise ValueError(f"{path}: format {given['format']!r} is not supported")
        checks["date_time"] = True
    rest = set(given) - set(_CHECKS) - _PLAIN - {"type", "format", "properties", "required", "additionalProperties"}
    if rest:
        raise ValueError(f"{path}: {sorted(rest)} are not supported")
    return path, allowed, checks


def compile_schema(schema: dict) -> Contract:
    """The contract that a JSON Schema (a closed object of fields, closed objects of fields, and one
    object ``params`` of free keys) describes; what it cannot express is an error."""
    if schema.get("type", "object") != "object" or schema.get("additionalProperties") is not False:
        raise ValueError("an event is a closed object")
    rest = set(schema) - _PLAIN - {"type", "properties", "required", "additionalProperties"}
    if rest:
        raise ValueError(f"{sorted(rest)} are not supported")
    closed, rules, kinds = {}, [], []
    for name, given in schema["properties"].items():
        rules.append(_rule(name, given))
        more = given.get("additionalProperties")
        if name == FREE:
            if given.get("properties") or not isinstance(more, dict) or set(more) - _PLAIN - {"type"}:
                raise ValueError(f"{name} has free keys of given types")
            kinds = [more["type"]] if isinstance(more["type"], str) else list(more["type"])
        elif "properties" in given:
            if more is not False or given.get("required"):
                raise ValueError(f"{name} is a closed object without required fields")
            closed[name] = list(given["properties"])
            rules += [_rule(f"{name}.{k}", x) for k, x in given["properties"].items()]
    return Contract(list(schema["properties"]), list(schema.get("required", [])), closed, rules, kinds)


def _q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _types_text(allowed: list[str]) -> str:
    return ", ".join(f"'{t}'" for t in allowed)


def _py_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _json_type(x: str, schema: str) -> str:
    """JSON type of a variant: object, array, string, boolean, null, integer, number."""
    d = f"try_variant_get({x}, '$', 'double')"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN startswith({schema}, 'OBJECT') THEN 'object' WHEN startswith({schema}, 'ARRAY') THEN 'array' "
            f"WHEN {schema} = 'STRING' THEN 'string' WHEN {schema} = 'BOOLEAN' THEN 'boolean' WHEN {schema} = 'VOID' THEN 'null' "
            f"WHEN {schema} IN ('TINYINT', 'SMALLINT', 'INT', 'BIGINT') THEN 'integer' WHEN {d} = floor({d}) THEN 'integer' ELSE 'number' END")


def _keys(obj: str) -> str:
    """Keys of a variant object (variant -> map cast; no JSON text round trip)."""
    return f"map_keys(try_variant_get({obj}, '$', 'map<string,variant>'))"


def _in(x: str, values: list[str]) -> str:
    return f"{x} IN ({', '.join(_q(v) for v in values)})"


def _type_ok(t: str, allowed: list[str]) -> str:
    return _in(t, [*allowed, "integer"] if "number" in allowed else allowed)


def _err(path: str, cond: str, message: str) -> str:
    loc, key = path.replace(".", "/") if path else "<root>", path.replace(".", SEP)
    return f"CASE WHEN {cond} THEN named_struct('k', {_q(key)}, 'm', concat({_q(loc + ': ')}, {message})) END"


def _unexpected(keys: str, allowed: list[str], path: str) -> str:
    extra = f"filter({keys}, k -> NOT {_in('k', allowed)})"
    quoted = f"array_join(transform({extra}, k -> concat('\\'', k, '\\'')), ', ')"
    were = f"CASE WHEN size({extra}) = 1 THEN ' was' ELSE ' were' END"
    return _err(path, f"size({extra}) > 0", f"'Additional properties are not allowed (', {quoted}, {were}, ' unexpected)'")


def _column(path: str, what: str) -> str:
    return f"_{what}_{path.replace('.', '_')}"


def _is_time(s: str) -> str:
    return f"{s} RLIKE {_q(DATE_TIME_PATTERN)} AND try_to_timestamp({s}) IS NOT NULL"


def _field_errors(path: str, allowed: list[str], checks: dict, contract: Contract) -> list[str]:
    x, t, s = (_column(path, w) for w in ("x", "t", "s"))
    # rendered only inside a failing branch (CASE evaluates lazily)
    r = f"CASE WHEN {t} = 'string' THEN concat('\\'', {s}, '\\'') ELSE to_json({x}) END"
    present, text = f"{x} IS NOT NULL", f"{x} IS NOT NULL AND {t} = 'string'"
    out = [_err(path, f"{present} AND NOT {_type_ok(t, allowed)}", f"{r}, {_q(' is not of type ' + _types_text(allowed))}")]
    if "const" in checks:
        out.append(_err(path, f"{present} AND NOT ({t} = 'string' AND {s} = {_q(checks['const'])})", _q(f"'{checks['const']}' was expected")))
    if "min" in checks:
        out.append(_err(path, f"{text} AND char_length({s}) < {checks['min']}", f"{r}, ' is too short'"))
    if "max" in checks:
        out.append(_err(path, f"{text} AND char_length({s}) > {checks['max']}", f"{r}, ' is too long'"))
    if "pattern" in checks:
        whole = checks["pattern"].replace("$", r"\z")
        out.append(_err(path, f"{text} AND NOT {s} RLIKE {_q(whole)}", f"{r}, {_q(' does not match ' + repr(checks['pattern']))}"))
    if "date_time" in checks:
        out.append(_err(path, f"{text} AND NOT coalesce({_is_time(s)}, false)", f"{r}, {_q(' is not a ' + repr('date-time'))}"))
    if "enum" in checks:
        out.append(_err(path, f"{text} AND NOT {_in(s, checks['enum'])}", f"{r}, {_q(' is not one of ' + _py_list(checks['enum']))}"))
    if path in contract.closed_objects:
        out.append(f"CASE WHEN {present} AND {t} = 'object' THEN {_unexpected(_keys(x), contract.closed_objects[path], path)} END")
    if "max_properties" in checks:
        out.append(_err(path, f"{present} AND {t} = 'object' AND size({_keys(x)}) > {checks['max_properties']}", f"to_json({x}), ' has too many properties'"))
    return out


def with_contract_errors(df: DataFrame, event: str, params: str, out: str = "errors", contract: Contract = V0) -> DataFrame:
    """Add ``out``, the sorted ``location: message`` list for each event object (empty =
    valid).  ``event`` is the received object (variant), ``params`` the redacted params
    (variant).  The server stamp is folded in rather than materialised: after stamping,
    ``ingested_at`` is always present and a valid date-time, so it satisfies its rules.

    Staged projections: each field's value and JSON type are extracted once into columns,
    and the rules then reference those columns - the rule table never re-inlines the
    event expression.  Everything is SQL text, parsed and analysed by Spark in one step a stage."""
    rules, base = contract.field_rules, [f"`{c}`" for c in df.columns]

    def value(path: str) -> str:
        return params if path == FREE else "CAST(NULL AS VARIANT)" if path == STAMPED else f"variant_get({event}, '$.{path}', 'variant')"

    x = df.selectExpr(*base, f"array_union({_keys(event)}, array({_q(STAMPED)})) AS _keys", *(f"{value(p)} AS {_column(p, 'x')}" for p, _, _ in rules))
    x = x.selectExpr("*", *(f"schema_of_variant({_column(p, 'x')}) AS {_column(p, 'sv')}" for p, _, _ in rules))
    x = x.selectExpr("*", *(f"{_json_type(_column(p, 'x'), _column(p, 'sv'))} AS {_column(p, 't')}" for p, _, _ in rules),
                     *(f"CASE WHEN {_column(p, 'sv')} = 'STRING' THEN try_variant_get({_column(p, 'x')}, '$', 'string') END AS {_column(p, 's')}" for p, _, _ in rules))
    missing = [_err("", f"NOT array_contains(_keys, {_q(f)})", _q(f"'{f}' is a required property")) for f in contract.required]
    errors = [*missing, _unexpected("_keys", contract.root_fields, ""), *(e for path, allowed, checks in rules for e in _field_errors(path, allowed, checks, contract))]
    # params values: flat scalars only (one error per offending key)
    v = "e.value"
    rendered = f"CASE WHEN schema_of_variant({v}) = 'STRING' THEN concat('\\'', try_variant_get({v}, '$', 'string'), '\\'') ELSE to_json({v}) END"
    wrong = f"filter(map_entries(try_variant_get({params}, '$', 'map<string,variant>')), e -> NOT {_type_ok(_json_type(v, f'schema_of_variant({v})'), contract.param_types)})"
    per_key = (f"transform({wrong}, e -> named_struct('k', concat({_q(FREE + SEP)}, e.key), "
               f"'m', concat('{FREE}/', e.key, ': ', {rendered}, {_q(' is not of type ' + _types_text(contract.param_types))})))")
    found = f"transform(array_sort(concat(array_compact(array({', '.join(errors)})), coalesce({per_key}, array()))), e -> e.m)"
    return x.selectExpr(*base, f"{found} AS {out}")


_END = r"\z"
_SCHEMA_TYPES = {"string": "STRING", "null": "VOID", "integer": "TINYINT|SMALLINT|INT|BIGINT"}


def _schema_pattern(contract: Contract = V0) -> str:
    """Regex over ``schema_of_variant`` text that only objects of the contract's types match.

    Keys stand in sorted order, and every field is followed by ``", "`` (see
    :func:`surely_valid`).  ``params`` may hold any flat values."""
    def fields(prefix: str) -> str:
        out = []
        for path, allowed, _ in sorted(contract.field_rules, key=lambda r: r[0]):
            parent, _, key = path.rpartition(".")
            if parent != prefix:
                continue
            if path == FREE:
                kind = "OBJECT<[^<>]*>"
            elif path == STAMPED:
                kind = r"[A-Z]+(?:\([0-9,]*\))?"            # whatever was sent is overwritten
            elif allowed == ["object"]:
                kind = f"OBJECT<{fields(path)}>"
            else:
                kind = "(?:" + "|".join(_SCHEMA_TYPES[t] for t in allowed) + ")"
            out.append(f"(?:{key}: {kind}, )" + ("" if path in contract.required else "?"))
        return "".join(out)

    return rf"\AOBJECT<{fields('')}>\z"


TYPED = ("struct<schema_version:string,event_id:string,event_name:string,event_timestamp:string,anonymous_id:string,"
         "session_id:string,user_id:string,campaign:struct<source:string,medium:string,campaign:string,content:string,"
         "term:string,attribution:string>,device:struct<platform:string>>")


def surely_valid(event: str, schema: str, typed: str) -> Column:
    """True only for event objects that meet the whole contract :data:`V0`, at a fraction of its cost.

    ``event``, ``schema`` and ``typed`` name the columns of the object, its schema text and its
    typed read (as ``TYPED``).  The schema text proves all types and keys at once, the typed read
    gives the values.  False proves nothing: the rule table decides those rows."""
    ends = f"replace(replace({schema}, '>', ', >'), '<, >', '<>')"
    tests = [f"{ends} RLIKE {_q(_schema_pattern())}"]
    for path, _, checks in FIELD_RULES:
        if path in (STAMPED, FREE):
            continue
        value = f"{typed}.{path}"
        made = {"const": lambda x, v: f"{v} = {_q(x)}", "min": lambda x, v: f"char_length({v}) >= {x}", "max": lambda x, v: f"char_length({v}) <= {x}",
                "pattern": lambda x, v: f"{v} RLIKE {_q(x.replace('$', _END))}", "enum": lambda x, v: _in(v, x), "date_time": lambda x, v: _is_time(v)}
        tests += [f"coalesce({value} IS NULL OR ({made[name](given, value)}), false)" for name, given in checks.items()]
    given_params = f"variant_get({event}, '$.{FREE}', 'variant')"
    n_params = f"size({_keys(given_params)})"
    return F.expr(f"coalesce({' AND '.join(tests)} AND coalesce({n_params}, 0) <= {MAX_PARAMS}, false)")
