import json
import math
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from logweir.constants import ANY_TIME_PATTERN, EPOCH_TEXT, LINE_PATTERNS
from logweir.functions.patterns import line_pattern
from logweir.functions.text import json_object, last_key_wins, strip
from logweir.operators.parse import (
    first_lines,
    infer_field_types,
    parse_columns,
    parse_lines,
    union_of_keys,
    widen,
)

AUTH = LINE_PATTERNS["Auth_Logs"]

EDGE_LINES = [
    "",
    "   \t  ",
    "\t 2026-02-19 17:36:30 | EMP001 | login | 10.0.0.1 | password",
    '{"timestamp":"2026-02-19T17:36:30","user_id":"EMP001"}',
    '{"user_id":"EMP001"}',
    '{"final_ts":"2020-01-01 00:00:00"}',
    '{"a":null,"b":{"c":1},"d":[1,2]}',
    '{"a":1,"a":2}',
    "{'a':1}",
    '{"a":1} trailing',
    '{"a":1} {"b":2}',
    '{"a":1},{"b":2}',
    '{"a":1}] x [{"b":1}',
    '{"a":1},"e":1} x {"b":2}',
    '{"a":[{"b":1}],"c":{"d":{}}}',
    '{"a":NaN}',
    '{"a":-Infinity}',
    '{"a":123456789012345678901234567890}',
    '{"a":.5}',
    '{"a":1.}',
    '{"a":+1}',
    '{"a":01}',
    '{"a":1,}',
    '{"a":"\\q"}',
    '{"a":"\\u00e9\\n"}',
    '{"a":1} // note}',
    '{"a":"x\ty"}',
    "\ufeff{}",
    '{"a":\u00a01}',
    "{}",
    "{",
    "123",
    '"x"',
    "[1,2]",
    "null",
    "text with 2026-02-19T17:36:30 inside",
    "text with 2026-02-19 17:36:30 and 2027-01-01 00:00:00",
    "text without a time",
    "2026 | nope",
    "　 wide blanks 이름 　",
    "2026-02-19 17:36:30 | EMP　001 | login | 10.0.0.1 | password",
    "2026-02-19 17:36:30 | EMP\x1f001 | login | 10.0.0.1 | password",
    "2026-02-19 17:36:30 | 사번 | login | 10.0.0.1 | pass﷐word",
    "2026-02-19 17:36:30 | EMP001 | login | 10.0.0.1 | password | more",
]


def expected(line, pattern=None):
    """What a line should become, by the standard library."""
    line = line.strip()
    if not line:
        return None
    try:
        found = json.loads(line)
        if isinstance(found, dict):
            if "timestamp" in found:
                found["final_ts"] = found["timestamp"].replace("T", " ")
            return "json", found
    except json.JSONDecodeError:
        pass
    match = re.match(pattern, line) if pattern else None
    if match:
        found = match.groupdict()
        if "timestamp" in found:
            found["final_ts"] = found["timestamp"]
        return "regex", found
    time = re.search(ANY_TIME_PATTERN, line)
    stamp = time.group(1).replace("T", " ") if time else EPOCH_TEXT
    return "fallback", {"final_ts": stamp, "raw_message": line}


def as_text(value):
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, float) and not math.isfinite(value):
        # not a number in any column type: kept as quoted text
        return json.dumps(json.dumps(value))
    return json.dumps(value, separators=(",", ":"), ensure_ascii=False)


def check_lines(spark, lines, pattern):
    df = spark.createDataFrame(list(enumerate(lines)), "id int, value string")
    got = {r["id"]: r for r in parse_lines(df, pattern).collect()}
    for i, line in enumerate(lines):
        want = expected(line, pattern)
        if want is None:
            assert i not in got
            continue
        kind, fields = want
        assert got[i]["parse_kind"] == kind, line
        assert got[i]["fields"] == {k: as_text(v) for k, v in fields.items()}, line
    assert len(got) == sum(expected(x, pattern) is not None for x in lines)


def test_edge_lines_match_the_standard_library(spark):
    check_lines(spark, EDGE_LINES, AUTH)
    check_lines(spark, EDGE_LINES, None)


@pytest.mark.parametrize("source", LINE_PATTERNS)
def test_shipped_patterns(spark, source):
    lines = [
        "2026-02-19 17:36:30 | EMP001 | login | 10.0.0.1 | password",
        "2026-02-19 17:36:30 | 10.0.0.1 | GET /a b | 200 | curl/8 (x | y)",
        "2026-02-19 17:36:30 | 10.0.0.1 | GET /a | 200 | ",
        "[allow] src=10.0.0.1 dst=10.0.0.2 dst_port=443 proto=TCP service=Jira bytes=512",
        "[allow] src=10.0.0.1 dst=10.0.0.2 dst_port=x proto=TCP service=Jira bytes=512",
        "2026-02-19 17:36:30 | PC1 | EMP001 | process_start | a.exe | 42",
        "x 2026-02-19 17:36:30 | PC1 | EMP001 | process_start | a.exe | 42",
    ]
    check_lines(spark, lines, LINE_PATTERNS[source])


@pytest.mark.parametrize(
    "pattern,lines",
    [
        (r"(?P<a>x+)?(?P<b>\d+)", ["xx12", "12", "y"]),
        (r"(?:(?P<a>x)|(?P<b>y))(?P<c>.*)", ["x1", "y2", "z"]),
        (r"(?P<a>\w)(?P=a)(?P<b>[]|(]+)\Z", ["xx|(]", "xy|", "xx|"]),
        (r"(?P<a>[\s\S]+?);(?P<b>[^\s&]+)", ["a b;c&d", ";c", "q;　"]),
        (r"(?P<a>\S+)\s(?P<b>.+)$", ["a b c", "a\x1cb", "ab"]),
        (r"(x)(?P<a>\d)(?P<timestamp>t\d)?", ["x1", "x1t2"]),
    ],
)
def test_pattern_dialect(spark, pattern, lines):
    check_lines(spark, lines, pattern)


def test_pattern_needs_a_group():
    with pytest.raises(ValueError):
        line_pattern("abc")


_TEXT = st.text(st.sampled_from('{}[]":,\\ \t　ab1\'|-T0'), max_size=24)
_VALUE = st.recursive(
    st.none() | st.booleans() | st.integers(-99, 99) | st.text("ab }]{[\",'\\", max_size=6),
    lambda x: st.lists(x, max_size=2) | st.dictionaries(st.sampled_from("abc"), x, max_size=2),
    max_leaves=4,
)
_OBJECT = st.dictionaries(st.sampled_from(["a", "b", "k"]), _VALUE, max_size=3).map(
    lambda d: json.dumps(d, ensure_ascii=False)
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    objects=st.lists(_OBJECT, min_size=20, max_size=20),
    texts=st.lists(_TEXT, min_size=20, max_size=20),
)
def test_json_is_exactly_one_object(spark, objects, texts):
    """Objects, objects with text around them, and noise: JSON where the library says so."""
    lines = objects + [o + t for o, t in zip(objects, texts)] + texts
    lines += [a + t + b for a, t, b in zip(objects, texts, objects[1:])]
    df = spark.createDataFrame(list(enumerate(lines)), "id int, line string")
    stripped = df.withColumn("line", strip("line")).withColumn("m", json_object("line"))
    found = stripped.select("id", last_key_wins("m").alias("m"))
    got = {r["id"]: r["m"] for r in found.collect()}
    for i, line in enumerate(lines):
        try:
            value = json.loads(line.strip())
            want = set(value) if isinstance(value, dict) else None
        except json.JSONDecodeError:
            want = None
        assert (None if got[i] is None else set(got[i])) == want, line


def test_nothing_but_blank_lines_is_lost(spark):
    df = spark.createDataFrame([(x,) for x in EDGE_LINES], "value string")
    blank = sum(not x.strip() for x in EDGE_LINES)
    counts = parse_lines(df, AUTH).groupBy("parse_kind").count().collect()
    assert sum(r["count"] for r in counts) == len(EDGE_LINES) - blank


def test_fixed_form_agrees_with_open_form(spark):
    df = spark.createDataFrame([(x,) for x in EDGE_LINES], "value string")
    names = ["final_ts", "user_id", "timestamp", "a", "raw_message"]
    fixed = parse_columns(df, names, AUTH, extras=True).select("parse_kind", *names, "extras")
    opened = widen(parse_lines(df, AUTH), names)
    rest = F.map_filter("fields", lambda k, _: ~k.isin(names))
    opened = opened.select("parse_kind", *names, rest.alias("extras"))
    assert sorted(map(str, fixed.collect())) == sorted(map(str, opened.collect()))


def test_open_schema_helpers(spark):
    df = spark.createDataFrame([('{"b":1,"x":true}',), ('{"a":"t"}',)], "value string")
    parsed = parse_lines(df)
    assert sorted(r["key"] for r in union_of_keys(parsed).collect()) == ["a", "b", "x"]
    more = spark.createDataFrame([('{"b":1.5,"a":null}',), ("[1]",), ("text",), ("7",)], "line string")
    kinds = {r["key"]: r["type"] for r in infer_field_types(parsed.select("line").union(more)).collect()}
    assert kinds == {"a": "STRING", "b": "DECIMAL(21,1)", "x": "BOOLEAN"}
    many = spark.range(1).select(F.to_json(F.map_from_arrays(*[F.transform(F.sequence(F.lit(1), F.lit(3000)), lambda i: F.concat(F.lit("k"), i))] * 2)).alias("value"))
    assert union_of_keys(parse_lines(many)).count() == 3000


def test_blank_lines_stay_only_when_asked_for(spark):
    df = spark.createDataFrame([(" \t",), ("",), (None,), ('{"a":1}',)], "value string")
    assert parse_columns(df, ["a"]).count() == 1
    kinds = sorted(r["parse_kind"] for r in parse_columns(df, ["a", "final_ts"], blank=True).collect())
    assert kinds == ["blank"] * 3 + ["json"]


def test_first_lines(spark, tmp_path):
    (tmp_path / "a.log").write_text("  first a \nsecond\n", encoding="utf-8")
    (tmp_path / "b.log").write_text("\nsecond b\n", encoding="utf-8")
    (tmp_path / "c.log").write_text("only c", encoding="utf-8")
    got = {r["file_name"]: r["line"] for r in first_lines(spark.read.text(str(tmp_path))).collect()}
    assert got == {"a.log": "first a", "c.log": "only c"}
