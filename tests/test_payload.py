"""Payload normalization, case by case."""

import pytest

from snaptrail.functions.payload import with_payload_value

CASES = [
    ("no object", None, False, "<null>"),
    ("JSON null", "null", False, "<null>"),
    ("read failed", '{"name":"s","string_val":"x"}', True, "<unavailable>"),
    ("broken JSON", '{"name":', False, "<unavailable>"),
    ("empty text", "", False, "<unavailable>"),
    ("effective boolean", '{"effective_boolean_val":{"value":true}}', False, "True"),
    ("effective false", '{"effective_boolean_val":{"value":false}}', False, "False"),
    ("effective string keeps its case", '{"effective_string_val":{"value":"true"}}', False, "true"),
    ("empty string is a value", '{"effective_string_val":{"value":""},"string_val":"x"}', False, ""),
    ("effective integer", '{"effective_integer_val":{"value":42}}', False, "42"),
    ("huge integer", '{"effective_integer_val":{"value":12345678901234567890123}}', False, "12345678901234567890123"),
    (
        "boolean before string before integer",
        '{"effective_integer_val":{"value":1},"effective_string_val":{"value":"s"},"effective_boolean_val":{"value":true}}',
        False,
        "True",
    ),
    ("effective before direct", '{"string_val":{"value":"d"},"effective_string_val":{"value":"e"}}', False, "e"),
    ("null effective value", '{"effective_string_val":{"value":null},"string_val":{"value":"d"}}', False, "d"),
    ("one-field message", '{"effective_policy":{"mode":"strict"}}', False, "strict"),
    ("one field set", '{"effective_policy":{"mode":null,"on":true}}', False, "True"),
    ("whole message", '{"effective_policy":{"b":1,"a":"x","c":null}}', False, '{"a":"x","b":1}'),
    ("nested field", '{"effective_policy":{"list":[1,true]}}', False, "[1,true]"),
    ("first message by name", '{"effective_z":{"v":"z"},"effective_b":{"v":"b"}}', False, "b"),
    ("empty message is skipped", '{"effective_a":{},"effective_b":{"v":"b"}}', False, "b"),
    ("escaped name", '{"\\u0065ffective_a":{"v":"x"}}', False, "x"),
    ("message before direct", '{"string_val":"d","effective_a":{"v":"m"}}', False, "m"),
    ("direct wrapped", '{"name":"s","string_val":{"value":"x"}}', False, "x"),
    ("direct plain", '{"name":"s","boolean_val":true}', False, "True"),
    ("direct order", '{"value":"v","integer_val":3}', False, "3"),
    ("direct generic", '{"name":"s","value":"v"}', False, "v"),
    ("direct null value", '{"name":"s","string_val":{"value":null}}', False, "<not-set>"),
    ("direct empty object", '{"name":"s","string_val":{}}', False, "<not-set>"),
    ("direct other object", '{"name":"s","value":{"k":1}}', False, '{"k":1}'),
    ("only a name", '{"name":"s"}', False, "<not-set>"),
    ("null name", '{"name":null}', False, "<not-set>"),
    ("something else", '{"other":1}', False, '{"other":1}'),
    ("plain text", '"abc"', False, "abc"),
    ("plain boolean", "true", False, "True"),
    ("array", "[1,2]", False, "[1,2]"),
    ("last of repeats", '{"name":"s","string_val":"x","string_val":"y"}', False, "y"),
    ("last of repeats inside", '{"effective_string_val":{"value":"x","value":"y"}}', False, "y"),
    ("repeated message", '{"effective_a":{"v":"x"},"effective_a":{"v":1,"v":2}}', False, "2"),
    ("repeats in JSON", '{"effective_a":{"b":{"k":1,"k":{"z":1,"z":2}},"a":1,"a":2}}', False, '{"a":2,"b":{"k":{"z":2}}}'),
    ("last is null", '{"string_val":"x","string_val":null,"value":"v"}', False, "v"),
    ("one decimal", '{"name":"s","value":1.0}', False, "1.0"),
    ("trailing zero", '{"name":"s","value":1.50}', False, "1.5"),
    ("large exponent", '{"name":"s","value":1e20}', False, "1e+20"),
    ("large fixed", '{"name":"s","value":12345678.25}', False, "12345678.25"),
    ("below scientific", '{"name":"s","value":1e15}', False, "1000000000000000.0"),
    ("small", '{"name":"s","value":0.0001}', False, "0.0001"),
    ("smaller", '{"name":"s","value":0.000015}', False, "1.5e-05"),
    ("tiny", '{"name":"s","value":-2.5e-300}', False, "-2.5e-300"),
    ("overflow", '{"name":"s","value":-1e400}', False, "-inf"),
    ("negative zero", '{"name":"s","value":-0.0}', False, "-0.0"),
    ("negative decimal", '{"name":"s","value":-0.5}', False, "-0.5"),
    ("whole negative zero", '{"name":"s","value":-0}', False, "0"),
    ("decimals in JSON", '{"effective_a":{"b":[1.0,1e20,"1.0"],"a":true}}', False, '{"a":true,"b":[1.0,1e+20,"1.0"]}'),
    ("number as text", '{"name":"s","value":"1e20"}', False, "1e20"),
    ("null as text", '{"name":"s","value":"null"}', False, "null"),
    ("marks in a text", '{"name":"s","value":"|a|"}', False, "|a|"),
    ("only a mark", '{"name":"s","value":"|"}', False, "|"),
    ("object as text", '{"name":"s","value":"{}"}', False, "{}"),
    ("quotes and backslashes", '{"name":"s","value":"a\\"b\\\\\\"c\\\\"}', False, 'a"b\\"c\\'),
    ("quotes in JSON", '{"effective_a":{"b":{"x\\"":"y\\\\"},"a":1}}', False, '{"a":1,"b":{"x\\"":"y\\\\"}}'),
    ("spaces", ' { "name" : "s" , "value" : [ 1 , "a b" ] } ', False, '[1,"a b"]'),
    ("name sorted before longer", '{"effective_ab":{"v":"long"},"effective_a":{"v":"short"}}', False, "short"),
    ("two literals", '{"value":[1 2]}', False, "<unavailable>"),
    ("bad number", '{"value":01}', False, "<unavailable>"),
    ("number as name", '{1:2}', False, "<unavailable>"),
    ("bare word", '{"value":yes}', False, "<unavailable>"),
    ("single quotes", "{'value':1}", False, "<unavailable>"),
    ("text behind", '{"value":1} x', False, "<unavailable>"),
    ("two values", '1,"_":2', False, "<unavailable>"),
    ("only spaces", "  ", False, "<unavailable>"),
    ("deep", '{"value":[[[[[[[[{"a":1}]]]]]]]]}', False, '[[[[[[[[{"a":1}]]]]]]]]'),
    ("long text with escapes", '{"value":"' + '\\\\' * 50000 + '"}', False, "\\" * 50000),
    ("unknown read state", '{"name":"s"}', None, "<not-set>"),
]


@pytest.fixture(scope="module")
def values(spark):
    rows = [(name, payload, failed) for name, payload, failed, _ in CASES]
    df = spark.createDataFrame(rows, "case STRING, payload STRING, read_failed BOOLEAN")
    return {row.case: row.setting_value for row in with_payload_value(df).collect()}


@pytest.mark.parametrize("case,expected", [(c[0], c[3]) for c in CASES])
def test_value(values, case, expected):
    assert values[case] == expected
