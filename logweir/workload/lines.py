"""Line scans and parsing."""

from pyspark.sql import functions as F

from logweir.constants import LINE_PATTERNS
from logweir.functions.text import WHITESPACE
from logweir.operators.columns import nan_to_null, non_null_counts, drop_all_null_columns
from logweir.operators.parse import (
    field_keys,
    infer_field_types,
    nonblank_lines,
    parse_columns,
    parse_lines,
    widen,
)
from logweir.workload.tables import (
    EVENT_TIME,
    SQL_DOC_LINES,
    SQL_JSON,
    SQL_LINES,
    document_lines,
    event_lines,
    json_lines,
    table,
)

# The other engine's white space as code points. Fixed values, the oracle's own copy: here the
# pattern of a time anywhere, further down the patterns of the sources.
_SPACE = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)
_ANY_TIME = r"(\d{4}-\d{2}-\d{2}[T\s]\d{2}:\d{2}:\d{2})"


def scan_nonblank_lines(spark, folder):
    lines = nonblank_lines(document_lines(spark, folder))
    size = F.length("line").cast("bigint")
    return lines.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(size).alias("n_chars"),
        F.max(size).alias("longest"),
    )


def parse_json_fields(spark, folder):
    rows = parse_columns(json_lines(spark, folder), ["timestamp", "user_id", "action", "props", "final_ts"])
    k = F.get_json_object("props", "$.k")
    return rows.select("event_id", "timestamp", "final_ts", "user_id", "action", k.alias("k"))


def _pattern_rows(lines, source, names):
    parsed = parse_columns(lines, [*names, "final_ts"], LINE_PATTERNS[source])
    return parsed.filter("parse_kind = 'regex'").drop("parse_kind")


def _pipe(*parts):
    return " || ' | ' || ".join(parts)


_AUTH = _pipe(
    EVENT_TIME, "CAST(user_id AS STRING)", "event_type", "'10.0.0.' || CAST(user_id AS STRING)", "'password'"
)
_AUTH_SQL = r"'^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) \| (\S+) \| (\S+) \| (\S+) \| (\S+)'"


def parse_auth_lines(spark, folder):
    lines = table(spark, folder, "events").select("event_id", F.expr(_AUTH).alias("value"))
    return _pattern_rows(lines, "Auth_Logs", ["timestamp", "user_id", "action", "src_ip", "method"])


_WEB = _pipe(
    "substring(CAST(o_orderdate AS STRING), 1, 10) || ' 08:30:00'",
    "'10.0.' || CAST(o_custkey AS STRING)",
    "'GET /order/' || CAST(o_orderkey AS STRING)",
    "CAST(o_orderkey AS STRING)",
    "o_orderpriority || ' agent'",
)
_WEB_SQL = r"'^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) \| (\S+) \| ([^|]+) \| (\d+) \| (.*)'"


def parse_web_lines(spark, folder):
    lines = table(spark, folder, "orders").select("o_orderkey", F.expr(_WEB).alias("value"))
    return _pattern_rows(
        lines, "Web_Logs", ["timestamp", "src_ip", "request", "status", "user_agent"]
    )


_FW = (
    "'[' || l_returnflag || '] src=10.1.' || CAST(l_suppkey AS STRING) || ' dst=10.2.' || "
    "CAST(l_partkey AS STRING) || ' dst_port=' || CAST(l_linenumber AS STRING) || "
    "' proto=TCP service=' || l_linestatus || ' bytes=' || CAST(l_orderkey AS STRING)"
)
_FW_SQL = (
    r"'^\[(\S+)\] src=(\S+) dst=(\S+) dst_port=(\d+) proto=TCP service=(\S+) bytes=(\d+)'"
)


def parse_firewall_lines(spark, folder):
    lines = table(spark, folder, "lineitem").select(F.expr(_FW).alias("value"))
    names = ["action", "src_ip", "dst_ip", "dst_port", "app_name", "bytes"]
    rows = _pattern_rows(lines, "Firewall_Logs", names)
    return rows.groupBy("action", "src_ip", "dst_port", "app_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("bytes").cast("bigint")).alias("bytes"),
        F.max(F.length("dst_ip").cast("bigint")).alias("longest_dst"),
    )


_EP = _pipe(
    EVENT_TIME, "'PC' || CAST(user_id AS STRING)", "CAST(user_id AS STRING)", "event_type",
    "'app.exe'", "CAST(event_id AS STRING)",
)
_EP_SQL = (
    r"'^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) \| (\S+) \| (\S+) \| (\S+) \| (\S+) \| (\d+)'"
)


def parse_endpoint_lines(spark, folder):
    lines = table(spark, folder, "events").select("event_id", F.expr(_EP).alias("value"))
    names = ["timestamp", "machine_name", "user_id", "action", "process_name", "pid"]
    return _pattern_rows(lines, "Endpoint_Logs", names)


def _groups_sql(source, key, line, pattern, names, time=True):
    columns = ", ".join(f"regexp_extract(line, {pattern}, {i}) AS {n}" for i, n in enumerate(names, 1))
    final = f"regexp_extract(line, {pattern}, 1)" if time else "NULL"
    return (
        f"SELECT {key}, {columns}, {final} AS final_ts FROM "
        f"(SELECT {key}, {line} AS line FROM {source}) WHERE regexp_matches(line, {pattern})"
    )


def parse_fallback_time(spark, folder):
    texts = document_lines(spark, folder).select(
        F.lit("document").alias("origin"), F.col("doc_id").alias("id"), "pos", "value"
    )
    events = event_lines(spark, folder).select(
        F.lit("event").alias("origin"), F.col("event_id").alias("id"), F.lit(0).alias("pos"), "value"
    )
    rows = parse_columns(texts.union(events), ["final_ts", "raw_message"])
    return rows.filter("parse_kind = 'fallback'").select(
        "origin", "id", F.col("pos").cast("bigint").alias("pos"), "final_ts",
        F.md5("raw_message").alias("message_md5"),
    )


# lines that only look right: trailing text after an object, a pattern cut short
_MIXED = (
    f"CASE event_type WHEN 'signup' THEN '{{\"user_id\":' || CAST(user_id AS STRING) || '}}' "
    f"WHEN 'error' THEN '{{\"user_id\":' || CAST(user_id AS STRING) || '}} ' || '{{\"k\":1}}' "
    f"WHEN 'click' THEN {_AUTH} WHEN 'view' THEN {EVENT_TIME} || ' | cut' "
    "ELSE '  [' || CAST(user_id AS STRING) || ']' END"
)


def parse_dispatch_counts(spark, folder):
    lines = event_lines(spark, folder, _MIXED)
    parsed = parse_columns(lines, [], LINE_PATTERNS["Auth_Logs"])
    return parsed.groupBy("event_type", "parse_kind").agg(F.count(F.lit(1)).alias("n"))


def parse_open_fields(spark, folder):
    """Every line in the open form, seen through three of its keys."""
    parsed = parse_lines(event_lines(spark, folder), LINE_PATTERNS["Endpoint_Logs"])
    return widen(parsed, ["final_ts", "user_id", "raw_message"]).select(
        "event_id", "parse_kind", "final_ts", "user_id", "raw_message",
        F.size("fields").cast("bigint").alias("n_fields"),
    )


def union_of_fields(spark, folder):
    """Rows that carry each key, over all lines of a kind."""
    parsed = parse_lines(event_lines(spark, folder), LINE_PATTERNS["Endpoint_Logs"])
    keys = parsed.select("parse_kind", F.explode(F.map_keys("fields")).alias("key"))
    return keys.groupBy("parse_kind", "key").agg(F.count(F.lit(1)).alias("n"))


def infer_record_type(spark, folder):
    return infer_field_types(nonblank_lines(json_lines(spark, folder)))


def discover_keys(spark, folder):
    return field_keys(parse_lines(json_lines(spark, folder)), ["log_source"])


def count_non_null(spark, folder):
    rows = parse_columns(json_lines(spark, folder), ["user_id", "ip", "resource", "port"])
    return non_null_counts(rows.select("user_id", "ip", "resource", "port"))


def drop_empty_columns(spark, folder):
    rows = parse_columns(json_lines(spark, folder), ["action", "user", "never_sent", "mac"])
    return drop_all_null_columns(rows.drop("parse_kind"))


def clear_nan(spark, folder):
    noisy = F.when(F.col("value") > 100, F.lit(float("nan"))).otherwise(F.col("value"))
    return nan_to_null(table(spark, folder, "events").select("event_id", noisy.alias("value")))


QUERIES = {
    "scan_nonblank_lines": scan_nonblank_lines,
    "parse_json_fields": parse_json_fields,
    "parse_auth_lines": parse_auth_lines,
    "parse_web_lines": parse_web_lines,
    "parse_firewall_lines": parse_firewall_lines,
    "parse_endpoint_lines": parse_endpoint_lines,
    "parse_fallback_time": parse_fallback_time,
    "parse_dispatch_counts": parse_dispatch_counts,
    "parse_open_fields": parse_open_fields,
    "union_of_fields": union_of_fields,
    "infer_record_type": infer_record_type,
    "discover_keys": discover_keys,
    "count_non_null": count_non_null,
    "drop_empty_columns": drop_empty_columns,
    "clear_nan": clear_nan,
}

_FOUND = f"regexp_extract(line, '{_ANY_TIME}', 1)"
_FALLBACK_TIME = f"CASE WHEN {_FOUND} = '' THEN '1970-01-01 00:00:00' ELSE replace({_FOUND}, 'T', ' ') END"
_OBJECT = "(json_valid(line) AND starts_with(line, '{'))"

SQL = {
    "scan_nonblank_lines": f"""WITH {SQL_DOC_LINES}, s AS (SELECT source, trim(value, {_SPACE}) AS line FROM d)
SELECT source, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars,
 max(length(line)) AS longest FROM s WHERE line <> '' GROUP BY source""",
    "parse_json_fields": f"""WITH {SQL_JSON} SELECT event_id, json_extract_string(line, '$.timestamp') AS "timestamp",
 replace(json_extract_string(line, '$.timestamp'), 'T', ' ') AS final_ts,
 json_extract_string(line, '$.user_id') AS user_id, json_extract_string(line, '$.action') AS action,
 json_extract_string(line, '$.props.k') AS k FROM j""",
    "parse_auth_lines": _groups_sql(
        "events", "event_id", _AUTH, _AUTH_SQL, ['"timestamp"', "user_id", "action", "src_ip", '"method"']
    ),
    "parse_web_lines": _groups_sql(
        "orders", "o_orderkey", _WEB, _WEB_SQL, ['"timestamp"', "src_ip", "request", "status", "user_agent"]
    ),
    "parse_firewall_lines": f"""WITH g AS (SELECT regexp_extract(line, {_FW_SQL}, 1) AS action,
 regexp_extract(line, {_FW_SQL}, 2) AS src_ip, regexp_extract(line, {_FW_SQL}, 3) AS dst_ip,
 regexp_extract(line, {_FW_SQL}, 4) AS dst_port, regexp_extract(line, {_FW_SQL}, 5) AS app_name,
 CAST(regexp_extract(line, {_FW_SQL}, 6) AS BIGINT) AS bytes FROM (SELECT {_FW} AS line FROM lineitem))
SELECT action, src_ip, dst_port, app_name, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes,
 max(length(dst_ip)) AS longest_dst FROM g GROUP BY ALL""",
    "parse_endpoint_lines": _groups_sql(
        "events", "event_id", _EP, _EP_SQL,
        ['"timestamp"', "machine_name", "user_id", "action", "process_name", "pid"],
    ),
    "parse_fallback_time": f"""WITH {SQL_DOC_LINES}, {SQL_LINES}, a AS (
 SELECT 'document' AS origin, doc_id AS id, CAST(pos AS BIGINT) AS pos, trim(value, {_SPACE}) AS line FROM d
 UNION ALL SELECT 'event', event_id, 0, line FROM l)
SELECT origin, id, pos, {_FALLBACK_TIME} AS final_ts, md5(line) AS message_md5 FROM a
WHERE line <> '' AND NOT {_OBJECT}""",
    "parse_dispatch_counts": f"""WITH m AS (SELECT event_type, trim({_MIXED}) AS line FROM events)
SELECT event_type, CASE WHEN {_OBJECT} THEN 'json' WHEN regexp_matches(line, {_AUTH_SQL}) THEN 'regex'
 ELSE 'fallback' END AS parse_kind, count(*) AS n FROM m GROUP BY ALL""",
    "parse_open_fields": f"""WITH {SQL_LINES}, k AS (SELECT event_id, line, CASE WHEN {_OBJECT} THEN 'json'
 WHEN regexp_matches(line, {_EP_SQL}) THEN 'regex' ELSE 'fallback' END AS parse_kind FROM l),
 j AS (SELECT *, CASE WHEN parse_kind = 'json' THEN line END AS o FROM k)
SELECT event_id, parse_kind,
 CASE parse_kind WHEN 'json' THEN replace(json_extract_string(o, '$.timestamp'), 'T', ' ')
  WHEN 'regex' THEN regexp_extract(line, {_EP_SQL}, 1) ELSE {_FALLBACK_TIME} END AS final_ts,
 CASE parse_kind WHEN 'json' THEN json_extract_string(o, '$.user_id')
  WHEN 'regex' THEN regexp_extract(line, {_EP_SQL}, 3) END AS user_id,
 CASE WHEN parse_kind = 'fallback' THEN line END AS raw_message,
 CAST(CASE parse_kind WHEN 'json' THEN len(json_keys(o)) + 1 WHEN 'regex' THEN 7 ELSE 2 END AS BIGINT) AS n_fields
FROM j""",
    "union_of_fields": f"""WITH {SQL_LINES}, k AS (SELECT line, CASE WHEN {_OBJECT} THEN 'json'
 WHEN regexp_matches(line, {_EP_SQL}) THEN 'regex' ELSE 'fallback' END AS parse_kind FROM l),
 f AS (SELECT parse_kind, unnest(CASE parse_kind
  WHEN 'json' THEN list_append(json_keys(CASE WHEN {_OBJECT} THEN line END), 'final_ts')
  WHEN 'regex' THEN ['timestamp', 'machine_name', 'user_id', 'action', 'process_name', 'pid', 'final_ts']
  ELSE ['final_ts', 'raw_message'] END) AS "key" FROM k)
SELECT parse_kind, "key", count(*) AS n FROM f GROUP BY ALL""",
    "infer_record_type": f"""WITH {SQL_JSON}, k AS (SELECT line, unnest(json_keys(line)) AS "key" FROM j)
SELECT DISTINCT "key", CASE json_type(line, '$.' || "key") WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'BIGINT'
 WHEN 'OBJECT' THEN 'OBJECT<k: BIGINT>' END AS type FROM k""",
    "discover_keys": f"""WITH {SQL_JSON}, k AS (SELECT log_source, unnest(json_keys(line)) AS "key" FROM j
 UNION ALL SELECT log_source, 'final_ts' FROM j WHERE json_exists(line, '$.timestamp'))
SELECT DISTINCT log_source, "key" FROM k""",
    "count_non_null": f"""WITH {SQL_JSON} SELECT count(json_extract_string(line, '$.user_id')) AS user_id,
 count(json_extract_string(line, '$.ip')) AS ip, count(json_extract_string(line, '$.resource')) AS resource,
 count(json_extract_string(line, '$.port')) AS port FROM j""",
    "drop_empty_columns": f"""WITH {SQL_JSON} SELECT event_id, event_type, log_source,
 json_extract_string(line, '$.action') AS action, json_extract_string(line, '$.user') AS "user" FROM j""",
    "clear_nan": "SELECT event_id, CASE WHEN value > 100 THEN NULL ELSE value END AS value FROM events",
}
