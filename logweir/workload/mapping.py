"""Field mapping, the standard event shape, and rule learning."""

from pyspark.sql import functions as F

from logweir.constants import KEY_SYNONYMS, KEY_SYNONYMS_BASIC, MAPPING_RULES
from logweir.operators.columns import classify_name, complete_required, fill_defaults, standard_event
from logweir.operators.mapping import (
    apply_rules,
    apply_rules_by_source,
    first_source,
    infer_rules,
    rules_as_xml,
)
from logweir.operators.parse import parse_columns, parse_lines
from logweir.schemas import RULE
from logweir.sources.rules import rules_from_xml
from logweir.workload.tables import SQL_JSON, json_lines, table

_KEYS = ["user_id", "user", "department", "action", "ip", "src_ip"]
_INGEST = "2026-01-01 00:00:00"


def _records(spark, folder, keys=_KEYS):
    return parse_columns(json_lines(spark, folder), keys).drop("parse_kind")


def _mapped(policy):
    def run(spark, folder):
        rows = apply_rules(_records(spark, folder), MAPPING_RULES["Auth_Logs"], policy)
        return rows.select("event_id", "user_id", "department", "action", "src_ip")

    return run


def map_fields_by_source(spark, folder):
    """Rules as data: each source's own rules on rows of all sources."""
    rules = spark.createDataFrame(
        [(s, i, t, f) for s, pairs in MAPPING_RULES.items() for i, (t, f) in enumerate(pairs)], RULE
    )
    mapped = apply_rules_by_source(parse_lines(json_lines(spark, folder)), rules)
    wanted = ["user_id", "department", "action", "src_ip", "device_id", "resource"]
    return mapped.select("event_id", *[F.col("mapped")[c].alias(c) for c in wanted])


def complete_columns(spark, folder):
    rows = complete_required(_records(spark, folder, ["user_id", "action"]))
    return rows.select("event_id", "user_id", "user", "department", "action", "src_ip", "log_source")


def fill_missing(spark, folder):
    rows = fill_defaults(_records(spark, folder, ["user_id", "user", "department", "action", "src_ip"]))
    return rows.select("event_id", "user_id", "user", "department", "action", "src_ip")


def normalise_events(spark, folder):
    """Mapping, defaults, source tag and event time of all sources' JSON lines."""
    rows = _records(spark, folder, [*_KEYS, "final_ts", "timestamp"])
    rows = apply_rules(rows, MAPPING_RULES["Web_Logs"])
    events = standard_event(rows, F.col("log_source"), F.lit(_INGEST))
    return events.select(
        "event_id", "user_id", "user", "department", "action", "src_ip", "log_source",
        "final_ts", "timestamp", "time_inferred",
    )


_FILES = (
    "CASE event_type WHEN 'signup' THEN '/logs/authentication_activity.log' "
    "WHEN 'view' THEN '/logs/webserver_endpoint.log' WHEN 'click' THEN 'endpoint_activity.log' "
    "WHEN 'purchase' THEN 'firewall_' || CAST(event_id AS STRING) || '.log' ELSE 'other.log' END"
)


def classify_files(spark, folder):
    names = table(spark, folder, "events").select("event_id", F.expr(_FILES).alias("file_name"))
    return names.select("event_id", classify_name("file_name").alias("log_source"))


_URL_PARTS = [("/fr/", "French"), ("m.", "Mobile"), ("https://", "Secure")]


def classify_urls(spark, folder):
    pages = table(spark, folder, "pages")
    return pages.select("page_id", classify_name("url", _URL_PARTS).alias("site"))


def _inferred(synonyms):
    def run(spark, folder):
        rules = infer_rules(parse_lines(json_lines(spark, folder)), synonyms=synonyms)
        return rules.withColumn("pos", F.col("pos").cast("bigint"))

    return run


def mapping_documents(spark, folder):
    """The registry's content: one document per source."""
    return rules_as_xml(infer_rules(parse_lines(json_lines(spark, folder))))


def mapping_from_documents(spark, folder):
    """Rules read back from their documents, and the first source of each target."""
    return first_source(rules_from_xml(mapping_documents(spark, folder)))


QUERIES = {
    "map_fields_last": _mapped("last"),
    "map_fields_last_present": _mapped("last_present"),
    "map_fields_first_present": _mapped("first_present"),
    "map_fields_by_source": map_fields_by_source,
    "complete_columns": complete_columns,
    "fill_missing": fill_missing,
    "normalise_events": normalise_events,
    "classify_files": classify_files,
    "classify_urls": classify_urls,
    "infer_mapping": _inferred(KEY_SYNONYMS),
    "infer_mapping_basic": _inferred(KEY_SYNONYMS_BASIC),
    "mapping_documents": mapping_documents,
    "mapping_from_documents": mapping_from_documents,
}


def _get(key):
    return f"json_extract_string(line, '$.{key}')"


# Fixed values, the oracle's own copy: the two synonym tables.
_ALL_SYNONYMS = (
    "('user', 'user_id'), ('user_id', 'user_id'), ('ip', 'src_ip'), ('src_ip', 'src_ip'), "
    "('department', 'department'), ('action', 'action'), ('device_id', 'device_id'), ('resource', 'resource')"
)
_FEW_SYNONYMS = "('user', 'user_id'), ('ip', 'src_ip'), ('department', 'department'), ('action', 'action')"


def _infer_sql(synonyms):
    return f"""{SQL_JSON}, s(source, target) AS (VALUES {synonyms}),
 k AS (SELECT log_source, unnest(json_keys(line)) AS source,
  unnest(generate_series(1, len(json_keys(line)))) AS p FROM j),
 m AS (SELECT log_source, source, target, min(p) AS p FROM k JOIN s USING (source) GROUP BY ALL),
 a AS (SELECT * FROM m UNION ALL BY NAME SELECT DISTINCT log_source, 'mapped_name' AS source,
  'emp_name' AS target, 999 AS p FROM m WHERE target = 'user_id'),
 r AS (SELECT log_source, row_number() OVER (PARTITION BY log_source ORDER BY p, source) - 1 AS pos,
  target, source FROM a)"""


_RULES_SQL = _infer_sql(_ALL_SYNONYMS)

SQL = {
    "map_fields_last": f"""WITH {SQL_JSON} SELECT event_id, {_get('user')} AS user_id,
 {_get('department')} AS department, {_get('action')} AS action, {_get('ip')} AS src_ip FROM j""",
    "map_fields_last_present": f"""WITH {SQL_JSON} SELECT event_id,
 coalesce({_get('user')}, {_get('user_id')}) AS user_id, {_get('department')} AS department,
 {_get('action')} AS action, coalesce({_get('ip')}, {_get('src_ip')}) AS src_ip FROM j""",
    "map_fields_first_present": f"""WITH {SQL_JSON} SELECT event_id,
 coalesce({_get('user_id')}, {_get('user')}) AS user_id, {_get('department')} AS department,
 {_get('action')} AS action, coalesce({_get('ip')}, {_get('src_ip')}) AS src_ip FROM j""",
    "map_fields_by_source": f"""WITH {SQL_JSON}, k AS (SELECT *, log_source <> 'Error_Text' AS ruled FROM j)
SELECT event_id, CASE WHEN ruled THEN coalesce({_get('user')}, {_get('user_id')}) END AS user_id,
 CASE WHEN ruled THEN {_get('department')} END AS department, CASE WHEN ruled THEN {_get('action')} END AS action,
 CASE log_source WHEN 'Firewall_Logs' THEN {_get('src_ip')} WHEN 'Auth_Logs' THEN {_get('ip')}
  WHEN 'Web_Logs' THEN {_get('ip')} END AS src_ip,
 CASE WHEN log_source = 'Endpoint_Logs' THEN {_get('device_id')} END AS device_id,
 CASE WHEN log_source = 'Web_Logs' THEN {_get('resource')} END AS resource FROM k""",
    "complete_columns": f"""WITH {SQL_JSON} SELECT event_id, {_get('user_id')} AS user_id,
 CAST(NULL AS VARCHAR) AS "user", CAST(NULL AS VARCHAR) AS department, {_get('action')} AS action,
 CAST(NULL AS VARCHAR) AS src_ip, log_source FROM j""",
    "fill_missing": f"""WITH {SQL_JSON} SELECT event_id, coalesce({_get('user_id')}, 'Unknown_ID') AS user_id,
 coalesce({_get('user')}, 'Unknown_User') AS "user", coalesce({_get('department')}, 'Unknown_Dept') AS department,
 coalesce({_get('action')}, 'Unknown_Action') AS action, coalesce({_get('src_ip')}, 'Internal') AS src_ip FROM j""",
    "normalise_events": f"""WITH {SQL_JSON}, t AS (SELECT *, CAST(replace({_get('timestamp')}, 'T', ' ') AS TIMESTAMP) AS known FROM j)
SELECT event_id, coalesce({_get('user')}, {_get('user_id')}, 'Unknown_ID') AS user_id,
 coalesce({_get('user')}, 'Unknown_User') AS "user", coalesce({_get('department')}, 'Unknown_Dept') AS department,
 coalesce({_get('action')}, 'Unknown_Action') AS action,
 coalesce({_get('ip')}, {_get('src_ip')}, 'Internal') AS src_ip, log_source,
 coalesce(known, TIMESTAMP '{_INGEST}') AS final_ts,
 strftime(coalesce(known, TIMESTAMP '{_INGEST}'), '%Y-%m-%d %H:%M:%S') AS "timestamp",
 known IS NULL AS time_inferred FROM t""",
    "classify_files": f"""SELECT event_id, CASE WHEN contains(n, 'authentication') THEN 'Auth_Logs'
 WHEN contains(n, 'webserver') THEN 'Web_Logs' WHEN contains(n, 'endpoint') THEN 'Endpoint_Logs'
 WHEN contains(n, 'firewall') THEN 'Firewall_Logs' ELSE 'Unknown' END AS log_source
FROM (SELECT event_id, {_FILES} AS n FROM events)""",
    "classify_urls": """SELECT page_id, CASE WHEN contains(url, '/fr/') THEN 'French' WHEN contains(url, 'm.')
 THEN 'Mobile' WHEN contains(url, 'https://') THEN 'Secure' ELSE 'Unknown' END AS site FROM pages""",
    "infer_mapping": f"WITH {_RULES_SQL} SELECT * FROM r",
    "infer_mapping_basic": f"WITH {_infer_sql(_FEW_SYNONYMS)} SELECT * FROM r",
    "mapping_documents": f"""WITH {_RULES_SQL} SELECT log_source AS source_name,
 '<parser name="' || log_source || '">' || chr(10) || string_agg('    <field target="' || target ||
 '" source="' || source || '"/>', chr(10) ORDER BY pos) || chr(10) || '</parser>' AS parser_xml
FROM r GROUP BY log_source""",
    "mapping_from_documents": f"""WITH {_RULES_SQL} SELECT log_source, target, arg_min(source, pos) AS source
FROM r GROUP BY ALL""",
}
