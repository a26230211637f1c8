"""Detection, fingerprints, and the whole plan from lines to scored alerts."""

import uuid
from functools import reduce

from pyspark.sql import functions as F

from logweir.functions.fingerprint import with_row_id
from logweir.operators.detect import score_model, score_rule_table, score_rules, to_notify
from logweir.operators.totals import source_totals, union_all
from logweir.plans.events import prepared_lookup, scored_events
from logweir.plans.stages import run_stages
from logweir.session import shared_folder
from logweir.sinks.alerts import as_documents
from logweir.workload.tables import SOURCE_OF_TYPE, SQL_LINES, source_lines, source_spec, table

_ACTION = (
    "CASE event_type WHEN 'error' THEN 'SSH_BruteForce' WHEN 'purchase' THEN 'Unauthorized_DB_Dump' "
    "WHEN 'signup' THEN 'Reverse_Shell_C2' WHEN 'view' THEN 'Massive_FTP_Exfiltration' ELSE 'login' END"
)


def _actions(spark, folder):
    return table(spark, folder, "events").select("event_id", F.expr(_ACTION).alias("action"))


def score_by_rules(spark, folder):
    return score_rules(_actions(spark, folder))


def score_keeps_given(spark, folder):
    """Rows without a rule keep the score and message they came with."""
    rows = table(spark, folder, "events").select(
        "event_id",
        F.expr(_ACTION).alias("action"),
        F.col("value").alias("risk_score"),
        F.col("event_type").alias("alert_message"),
    )
    return score_rules(rows)


def score_by_rule_table(spark, folder):
    """Rules as data, matched on another column: here each nation's customers."""
    rules = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("match_value"),
        (F.col("n_regionkey") * 10.0).alias("risk_score"),
        F.col("n_name").alias("alert_message"),
    )
    people = table(spark, folder, "customer").select(
        "c_custkey", (F.col("c_nationkey") * 2).alias("nation")
    )
    return score_rule_table(people, rules, match_col="nation")


def alerts_to_notify(spark, folder):
    return to_notify(score_rules(_actions(spark, folder))).select("event_id", "risk_score")


def stage_chain(spark, folder):
    """A stage that cannot be planned is skipped; the others apply in order."""

    def broken(df):
        return df.select("no_such_column")

    def urgent(df):
        return df.withColumn("urgent", F.col("risk_score") >= 90)

    rows = run_stages(_actions(spark, folder), [score_rules, broken, score_model, urgent])
    return rows.select("event_id", "risk_score", "urgent")


def fingerprint_events(spark, folder):
    rows = table(spark, folder, "events").select(
        F.col("event_type").alias("action"), "event_id", F.col("ts").alias("final_ts"), "props", "user_id"
    )
    return with_row_id(rows).select("event_id", "row_id")


def fingerprint_numbers(spark, folder):
    """Floating point values enter the id with a fixed number of decimals."""
    rows = table(spark, folder, "lineitem")
    return with_row_id(rows).groupBy("row_id").agg(F.count(F.lit(1)).alias("n"))


def _lookup(spark, folder):
    people = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("emp_id"), F.col("s_name").alias("emp_name")
    )
    return prepared_lookup(people, f"{shared_folder(spark)}/runs/{uuid.uuid4().hex}/people")


_SINCE = "2024-01-05 00:00:00"


def alert_documents_of(spark, folder):
    """Every source's lines through the whole plan, brought together."""
    lookup = _lookup(spark, folder)
    frames = [
        as_documents(
            scored_events(source_lines(spark, folder, s), source_spec(s), last=_SINCE, lookup=lookup)
        )
        for s in SOURCE_OF_TYPE.values()
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)


_SHOWN = [
    "row_id", "final_ts", "timestamp", "log_source", "user_id", "user", "department", "action",
    "src_ip", "emp_name", "raw_message", "risk_score", "alert_message",
]


def scored_alerts(spark, folder):
    extras = F.to_json(F.array_sort(F.map_entries("extras")))
    return alert_documents_of(spark, folder).select(*_SHOWN, extras.alias("extras"))


def scored_totals(spark, folder):
    """Alerts per source and in all."""
    return source_totals(alert_documents_of(spark, folder))


def all_sources_by_name(spark, folder):
    """Sources with different columns as one table."""
    frames = [
        table(spark, folder, "customer").select(
            F.col("c_name").alias("user"), F.col("c_acctbal").alias("balance"), F.lit("hr").alias("log_source")
        ),
        table(spark, folder, "events").select(
            F.col("event_type").alias("action"), F.lit("events").alias("log_source")
        ),
        table(spark, folder, "supplier").select(
            F.col("s_name").alias("user"), F.lit("suppliers").alias("log_source")
        ),
    ]
    return union_all(frames).select("log_source", "user", "action", "balance")


def model_slot(spark, folder):
    """A batch function in the model slot, over the whole table in Arrow batches."""

    def half(batches):
        for rows in batches:
            rows["risk_score"] = rows["risk_score"] / 2
            yield rows

    rows = score_rules(_actions(spark, folder)).select("event_id", "risk_score")
    return score_model(rows, half)


QUERIES = {
    "score_by_rules": score_by_rules,
    "score_keeps_given": score_keeps_given,
    "score_by_rule_table": score_by_rule_table,
    "alerts_to_notify": alerts_to_notify,
    "stage_chain": stage_chain,
    "model_slot": model_slot,
    "fingerprint_events": fingerprint_events,
    "fingerprint_numbers": fingerprint_numbers,
    "scored_alerts": scored_alerts,
    "scored_totals": scored_totals,
    "all_sources_by_name": all_sources_by_name,
}

# Fixed values, the oracle's own copy: what the rules give.
_SCORE = (
    "CASE action WHEN 'Reverse_Shell_C2' THEN 99.0 WHEN 'Massive_FTP_Exfiltration' THEN 95.0 "
    "WHEN 'Unauthorized_DB_Dump' THEN 90.0 WHEN 'SSH_BruteForce' THEN 85.0"
)
_TEXT = (
    "CASE action WHEN 'Reverse_Shell_C2' THEN '🚨 CRITICAL: 랜섬웨어/C2 서버 비인가 통신 감지!' "
    "WHEN 'Massive_FTP_Exfiltration' THEN '🚨 HIGH: 내부자 대규모 기밀 유출 시도 (FTP)' "
    "WHEN 'Unauthorized_DB_Dump' THEN '🚨 HIGH: 비인가 DB 덤프 및 데이터 추출 시도' "
    "WHEN 'SSH_BruteForce' THEN '⚠️ WARN: 무차별 대입 공격 (SSH Brute Force) 도배'"
)
_PLAIN_TEXT = "Info: 정상 업무 활동"
_SQL_ACTIONS = f"a AS (SELECT event_id, {_ACTION} AS action FROM events)"
_SCORED = (
    f"CAST({_SCORE} ELSE 10.0 END AS DOUBLE) AS risk_score, "
    f"{_TEXT} ELSE '{_PLAIN_TEXT}' END AS alert_message"
)


def _entry(key, value):
    return f"""'{{"key":"{key}","value":"' || {value} || '"}}'"""


def _part(value):
    return f"lower(trim(coalesce(CAST({value} AS VARCHAR), 'null')))"


_ID = "CAST(event_id AS VARCHAR)"
_USER = "CAST(user_id AS VARCHAR)"
_HASHED = [
    _part("action"), _part("alert_message"), _part("CAST(nullif(bytes_total, 0) AS DECIMAL(38,6))"), _part("department"), "'null'", "'null'",
    _part("emp_name"), "'null'", _part("extras"), "\"timestamp\"", _part("log_source"), "'null'",
    _part("raw_message"), _part("CAST(nullif(risk_score, 0) AS DECIMAL(38,6))"), _part("src_ip"), "'null'",
    _part('"user"'), _part("user_id"),
]
# The same plan written by source: one branch per line form.
_SQL_ALERTS = f"""{SQL_LINES}, n AS (SELECT l.*, coalesce(s_name, 'Unknown_User') AS found,
  substring(CAST(ts AS VARCHAR), 1, 19) AS shown FROM l LEFT JOIN supplier ON user_id = s_suppkey),
 a AS (
 SELECT shown AS "timestamp", log_source, 'user ' || user_id AS user_id, 'user ' || user_id AS "user",
  'HR' AS department, 'login' AS action, '10.0.0.' || user_id AS src_ip, found AS emp_name,
  CAST(NULL AS VARCHAR) AS raw_message, CAST(NULL AS DOUBLE) AS bytes_total,
  '[' || {_entry('event_id', _ID)} || ',' || {_entry('ip', "'10.0.0.' || " + _USER)} || ',' ||
  {_entry('mapped_name', 'found')} || ']' AS extras
 FROM n WHERE event_type = 'signup'
 UNION ALL SELECT shown, log_source, 'user ' || user_id, 'user ' || user_id, 'Unknown_Dept',
  CASE WHEN value > 100 THEN 'Massive_FTP_Exfiltration' ELSE 'allow' END, '10.0.1.' || user_id, found, NULL,
  CAST(event_id AS DOUBLE), '[' || {_entry('dst_ip', "'10.0.9.9'")} || ',' || {_entry('event_id', _ID)} || ',' ||
  {_entry('mapped_name', 'found')} || ',' || {_entry('port', "'443'")} || ']'
 FROM n WHERE event_type = 'purchase'
 UNION ALL SELECT shown, log_source, 'Unknown_ID', 'Unknown_User', 'Unknown_Dept', 'Unknown_Action',
  '10.0.0.' || user_id, 'Unknown_User', NULL, NULL, '[' || {_entry('mapped_name', "'Unknown_User'")} || ',' ||
  {_entry('request', "'GET /item/' || " + _ID)} || ',' || {_entry('status', "'200'")} || ',' ||
  {_entry('user_agent', "'agent ' || " + _USER)} || ']' FROM n WHERE event_type = 'view'
 UNION ALL SELECT shown, log_source, {_USER}, 'Unknown_User', 'Unknown_Dept', 'process_start', 'Internal', found,
  NULL, NULL, '[' || {_entry('machine_name', "'PC' || " + _USER)} || ',' || {_entry('mapped_name', 'found')} || ',' ||
  {_entry('pid', _ID)} || ',' || {_entry('process_name', "'app.exe'")} || ']' FROM n WHERE event_type = 'click'
 UNION ALL SELECT shown, log_source, 'Unknown_ID', 'Unknown_User', 'Unknown_Dept', 'Unknown_Action', 'Internal',
  'Unknown_User', line, NULL, '[]' FROM n WHERE event_type = 'error'),
 s AS (SELECT *, CAST("timestamp" AS TIMESTAMP) AS final_ts, {_SCORED} FROM a WHERE "timestamp" > '{_SINCE}')"""

SQL = {
    "score_by_rules": f"WITH {_SQL_ACTIONS} SELECT *, {_SCORED} FROM a",
    "score_keeps_given": f"""SELECT event_id, action, {_SCORE} ELSE value END AS risk_score,
 {_TEXT} ELSE event_type END AS alert_message FROM (SELECT *, {_ACTION} AS action FROM events)""",
    "score_by_rule_table": f"""SELECT c_custkey, c_nationkey * 2 AS nation,
 CAST(coalesce(n_regionkey * 10.0, 10.0) AS DOUBLE) AS risk_score,
 coalesce(n_name, '{_PLAIN_TEXT}') AS alert_message
FROM customer LEFT JOIN nation ON c_nationkey * 2 = n_nationkey""",
    "alerts_to_notify": f"WITH {_SQL_ACTIONS}, s AS (SELECT *, {_SCORED} FROM a) "
    "SELECT event_id, risk_score FROM s WHERE risk_score >= 90",
    "stage_chain": f"WITH {_SQL_ACTIONS}, s AS (SELECT *, {_SCORED} FROM a) "
    "SELECT event_id, risk_score, risk_score >= 90 AS urgent FROM s",
    "model_slot": f"WITH {_SQL_ACTIONS}, s AS (SELECT *, {_SCORED} FROM a) "
    "SELECT event_id, risk_score / 2 AS risk_score FROM s",
    "fingerprint_events": """SELECT event_id, md5(concat_ws('|', event_type, event_id,
 substring(CAST(ts AS VARCHAR), 1, 19), lower(trim(props)), user_id)) AS row_id FROM events""",
    "fingerprint_numbers": """SELECT md5(concat_ws('|', CAST(l_discount AS DECIMAL(38,6)),
 CAST(l_extendedprice AS DECIMAL(38,6)), l_linenumber, lower(l_linestatus), l_orderkey, l_partkey,
 CAST(l_quantity AS DECIMAL(38,6)), lower(l_returnflag), CAST(l_shipdate AS VARCHAR), l_suppkey, CAST(l_tax AS DECIMAL(38,6)))) AS row_id,
 count(*) AS n FROM lineitem GROUP BY ALL""",
    "scored_alerts": f"""WITH {_SQL_ALERTS} SELECT md5(concat_ws('|', {', '.join(_HASHED)})) AS row_id,
 {', '.join(f'"{c}"' for c in _SHOWN[1:])}, extras FROM s""",
    "scored_totals": f"WITH {_SQL_ALERTS} SELECT log_source, count(*) AS row_count FROM s GROUP BY ROLLUP (log_source)",
    "all_sources_by_name": """SELECT 'hr' AS log_source, c_name AS "user", NULL AS action, c_acctbal AS balance FROM customer
UNION ALL SELECT 'events', NULL, event_type, NULL FROM events
UNION ALL SELECT 'suppliers', s_name, NULL, NULL FROM supplier""",
}
