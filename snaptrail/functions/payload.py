"""One string value out of a typed JSON payload, with Spark's JSON functions.

The payload is first marked: every string gets a mark at its end, and every number, boolean and null
becomes a string with a mark at its start. Read as a map of texts, each level then keeps numbers as
they are written and members that repeat, which a parsed JSON value would not.

The expressions are SQL text, so that Spark parses each in one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrail.functions.values import NOT_SET, NULL_VALUE, UNAVAILABLE

# The typed messages tried first, and the direct fields tried last, in this order.
EFFECTIVE_FIELDS = ("effective_boolean_val", "effective_string_val", "effective_integer_val")
DIRECT_FIELDS = ("boolean_val", "string_val", "integer_val", "value")
EFFECTIVE_PREFIX = "effective_"

# Objects nested deeper than this inside a value are shown as they are written, members that repeat included.
NESTING = 4

_NUMBER = r"-?(?:0|[1-9][0-9]*)(?:[.][0-9]+)?(?:[eE][-+]?[0-9]+)?"
_LITERAL = rf"(?:true|false|null|{_NUMBER})"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _quotes_hidden(payload: str) -> str:
    """The payload with escaped quotes written as code points, so that a quote always starts or ends a string."""
    return rf"replace(replace({payload}, r'\\', r'\u005c'), r'\"', r'\u0022')"


def _is_plain(text: str) -> str:
    """Outside of strings there are only JSON's signs, and literals that are not used as names."""
    outside = f"""regexp_replace({text}, '"[^"]*+"', '""')"""
    signs = rf"regexp_replace({outside}, r'(?<![\w.+-]){_LITERAL}(?![\w.+-])(?!\s*:)', '')"
    return rf"""{signs} RLIKE r'^[\s{{}}\[\]:,"]*$'"""


def _marked(text: str) -> str:
    return rf"""regexp_replace({text}, r'"([^"]*+)"|([^"\s{{}}\[\]:,]++)', r'"$1|$2"')"""


def _root(payload: str) -> str:
    """The marked payload; NULL for broken JSON."""
    hidden = _quotes_hidden(payload)
    wrapped = """concat('[{"_":', """ + _marked("_text") + """, '}]')"""
    parsed = f"from_json({wrapped}, 'array<map<string,string>>', map('allowSingleQuotes', 'false'))"
    only = "if(size(_all) = 1 AND size(_all[0]) = 1, element_at(_all[0], '_'), NULL)"
    return _let(hidden, "_text", f"if({_is_plain('_text')}, {_let(parsed, '_all', only)}, NULL)")


def _members(node: str) -> str:
    """The fields of an object by marked name, the last of each name; NULL for anything that is no object."""
    names = "array_distinct(map_keys(_m))"
    last = "get(map_values(_m), CAST(size(_m) - array_position(reverse(map_keys(_m)), _n) AS INT))"
    deduplicated = f"if(size({names}) = size(_m), _m, map_from_arrays({names}, transform({names}, _n -> {last})))"
    fields = _let(f"from_json({node}, 'map<string,string>')", "_m", deduplicated)
    return f"if(right({node}, 1) = '}}', {fields}, NULL)"


def _member(node: str, name: str) -> str:
    """The field of an object; NULL if it is missing or null."""
    return f"nullif(element_at({_members(node)}, '{name}|'), '|null')"


def _number_text(number: str) -> str:
    """Whole numbers as written; others as the shortest text of the double, by Python's rules (1.0, 1e+20, 1.5e-05)."""
    as_double = f"CAST({number} AS DOUBLE)"
    whole = f"CAST(CAST({number} AS DOUBLE) AS DECIMAL(38, 21))"
    fixed = f"""regexp_replace(concat(if({number} LIKE '-%', '-', ''), CAST(abs({whole}) AS STRING)), '(?<=[.][0-9]{{1,21}})0+$', '')"""
    mantissa = "regexp_replace(substring_index(_d, 'E', 1), '[.]0$', '')"
    exponent = "CAST(substring_index(_d, 'E', -1) AS INT)"
    sign = f"if({exponent} < 0, 'e-', 'e+')"
    digits = f"lpad(CAST(abs({exponent}) AS STRING), greatest(2, length(CAST(abs({exponent}) AS STRING))), '0')"
    scientific = _let(f"CAST({as_double} AS STRING)", "_d", f"concat({mantissa}, {sign}, {digits})")
    return f"""CASE WHEN {number} = '-0' THEN '0' WHEN NOT {number} RLIKE '[.eE]' THEN {number}
        WHEN {as_double} = double('Infinity') THEN 'inf' WHEN {as_double} = double('-Infinity') THEN '-inf'
        WHEN {as_double} = 0 THEN if({number} LIKE '-%', '-0.0', '0.0')
        WHEN abs({as_double}) >= 1e-4D AND abs({as_double}) < 1e16D THEN {fixed} ELSE {scientific} END"""


def _literal_text(node: str) -> str:
    return f"""CASE WHEN {node} IN ('|true', '|false', '|null') THEN substr({node}, 2)
        ELSE {_let(f"substr({node}, 2)", "_number", _number_text("_number"))} END"""


def _quoted(text: str) -> str:
    return _let(f"to_json(array({text}))", "_q", "substr(_q, 2, length(_q) - 2)")


def _as_written(node: str) -> str:
    """A marked object or array without the marks."""
    return rf"""regexp_replace(regexp_replace({node}, r'(?<=[:,\[])"[|]({_LITERAL})"', '$1'), r'[|]"', '"')"""


def _json(node: str, depth: int = NESTING, drop_nulls: str | None = None) -> str:
    """JSON text of a marked value: names sorted, the last of members that repeat, numbers as texts have them.

    ``drop_nulls`` is a condition under which fields of the object itself that are null are left out.
    """
    if depth == 0:
        inner = _as_written(node)
    else:
        child = f"_c{depth}"
        names = "array_sort(transform(map_keys(_o), _k -> left(_k, length(_k) - 1)))"
        members = _members(node)
        if drop_nulls:
            members = f"map_filter({members}, (_, _e) -> NOT ({drop_nulls} AND _e = '|null'))"
        named = _let(members, "_o", f"transform({names}, _k -> struct(_k AS name, element_at(_o, concat(_k, '|')) AS value))")
        listed = f"transform(from_json({node}, 'array<string>'), _e -> struct(CAST(NULL AS STRING) AS name, _e AS value))"
        children = f"if(right({node}, 1) = '}}', {named}, {listed})"
        name = f"if({child}.name IS NULL, '', concat({_quoted(f'{child}.name')}, ':'))"
        shown = f"concat({name}, {_json(f'{child}.value', depth - 1)})"
        inner = f"concat(left({node}, 1), array_join(transform({children}, {child} -> {shown}), ','), right({node}, 1))"
    return f"""CASE WHEN right({node}, 1) = '|' THEN {_quoted(f"left({node}, length({node}) - 1)")}
        WHEN right({node}, 1) IN ('}}', ']') THEN {inner} ELSE {_literal_text(node)} END"""


def _text(node: str, drop_nulls: str) -> str:
    """Text of a marked value: booleans as True/False, objects and arrays as JSON."""
    return f"""CASE WHEN right({node}, 1) = '|' THEN left({node}, length({node}) - 1)
        WHEN {node} = '|true' THEN 'True' WHEN {node} = '|false' THEN 'False'
        ELSE {_json(node, drop_nulls=drop_nulls)} END"""


def _first_message(fields: str) -> str:
    """The first effective message, by name, that has a set field: that field if it is the only one, else the message."""
    names = f"filter(map_keys({fields}), _k -> startswith(_k, '{EFFECTIVE_PREFIX}'))"
    sorted_names = f"array_sort(transform({names}, _k -> left(_k, length(_k) - 1)))"
    values = f"map_values(map_filter({_members('_s')}, (_, _e) -> _e <> '|null'))"
    choice = "CASE size(_set) WHEN 0 THEN NULL WHEN 1 THEN get(_set, 0) ELSE _s END"
    chosen = _let(values, "_set", f"struct({choice} AS node, size(_set) > 1 AS is_message)")
    messages = f"transform({sorted_names}, _k -> element_at({fields}, concat(_k, '|')))"
    return f"get(filter(transform({messages}, _s -> {chosen}), _t -> _t.node IS NOT NULL), 0)"


def _field(fields: str, name: str) -> str:
    return f"nullif(element_at({fields}, '{name}|'), '|null')"


def _direct_node(fields: str, name: str) -> str:
    """A direct field is a plain value, or an object that wraps one in ``value``."""
    wrapped = "nullif(element_at(_w, 'value|'), '|null')"
    is_unset = "size(_w) = 0 OR map_contains_key(_w, 'value|')"
    inner = _let(_members("_field"), "_w", f"if(coalesce({is_unset}, false), {wrapped}, _field)")
    return _let(_field(fields, name), "_field", inner)


def with_payload_value(
    payloads: DataFrame,
    payload: str = "payload",
    read_failed: str = "read_failed",
    output: str = "setting_value",
) -> DataFrame:
    """Add ``output``: the one string that a JSON setting payload stands for.

    Tried in order: the typed effective fields, any other effective message (by name), the direct
    fields. A payload with only a name is "not set", NULL is "null", and a failed read or broken
    JSON is "unavailable". Of members that repeat the last counts. A whole number is shown as written,
    another as the shortest text of its double.
    """
    effective = [_member(_field("_fields", name), "value") for name in EFFECTIVE_FIELDS]
    direct = [_direct_node("_fields", name) for name in DIRECT_FIELDS]
    # A backslash may hide the prefix in an escaped name.
    may_have_message = rf"contains(`{payload}`, '{EFFECTIVE_PREFIX}') OR contains(`{payload}`, r'\')"
    message = f"if(_typed IS NULL AND ({may_have_message}), {_first_message('_fields')}, NULL)"
    unnamed = "if(coalesce(map_contains_key(_fields, 'name|'), false), NULL, _doc)"
    value = f"""
        CASE WHEN coalesce(`{read_failed}`, false) THEN '{UNAVAILABLE}'
             WHEN `{payload}` IS NULL THEN '{NULL_VALUE}'
             WHEN _doc IS NULL THEN '{UNAVAILABLE}'
             WHEN _doc = '|null' THEN '{NULL_VALUE}'
             WHEN _node IS NULL THEN '{NOT_SET}'
             ELSE {_text('_node', 'coalesce(_message.is_message, false)')} END"""
    # One column per step, so that each payload is parsed once and only opened as far as needed.
    return (
        payloads.withColumn("_doc", F.expr(_root(f"`{payload}`")))
        .withColumn("_fields", F.expr(_members("_doc")))
        .withColumn("_typed", F.expr(f"coalesce({', '.join(effective)})"))
        .withColumn("_message", F.expr(message))
        .withColumn("_node", F.expr(f"coalesce(_typed, _message.node, {', '.join(direct)}, {unnamed})"))
        .withColumn(output, F.expr(value))
        .drop("_doc", "_fields", "_typed", "_message", "_node")
    )
