"""The given tables in the role of logs.

`events` is rendered as log lines. The rendering is SQL text that both engines read, so
that the lines are the same on both sides; what is done to the lines is written twice.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from logweir.sources.spec import SourceSpec

EVENT_TIME = "substring(CAST(ts AS STRING), 1, 19)"
_USER = "CAST(user_id AS STRING)"
_ID = "CAST(event_id AS STRING)"
_ISO = f"replace({EVENT_TIME}, ' ', 'T')"

# event type -> source
SOURCE_OF_TYPE = {
    "signup": "Auth_Logs",
    "view": "Web_Logs",
    "click": "Endpoint_Logs",
    "purchase": "Firewall_Logs",
    "error": "Error_Text",
}
LOG_SOURCE = (
    "CASE event_type "
    + " ".join(f"WHEN '{t}' THEN '{s}'" for t, s in SOURCE_OF_TYPE.items())
    + " END"
)

_PERSON = f"""'"user_id":"' || {_USER} || '","user":"user ' || {_USER} || '"'"""
_AUTH = (
    f"""'{{"timestamp":"' || {_ISO} || '",' || {_PERSON} || ',"department":"HR","action":"login","ip":"10.0.0.' """
    f"""|| {_USER} || '","event_id":' || {_ID} || '}}'"""
)
_FIREWALL = (
    f"""'{{"timestamp":"' || {EVENT_TIME} || '",' || {_PERSON} || ',"src_ip":"10.0.1.' || {_USER} """
    """|| '","dst_ip":"10.0.9.9","action":"' || CASE WHEN value > 100 THEN 'Massive_FTP_Exfiltration' """
    f"""ELSE 'allow' END || '","port":443,"bytes_total":' || {_ID} || ',"event_id":' || {_ID} || '}}'"""
)
_WEB = f"{EVENT_TIME} || ' | 10.0.0.' || {_USER} || ' | GET /item/' || {_ID} || ' | 200 | agent ' || {_USER}"
_ENDPOINT = (
    f"{EVENT_TIME} || ' | PC' || {_USER} || ' | ' || {_USER} || ' | process_start | app.exe | ' || {_ID}"
)
_TEXT = f"'event ' || {_ID} || ' at ' || {_ISO} || ' of user ' || {_USER} || ' failed'"

# One line per event, in the form its source writes.
LINE = (
    f"CASE event_type WHEN 'signup' THEN {_AUTH} WHEN 'purchase' THEN {_FIREWALL} "
    f"WHEN 'view' THEN {_WEB} WHEN 'click' THEN {_ENDPOINT} ELSE {_TEXT} END"
)
# One JSON object per event, with the keys its source writes; errors have no user.
JSON_LINE = f"""CASE event_type
 WHEN 'signup' THEN {_AUTH}
 WHEN 'purchase' THEN {_FIREWALL}
 WHEN 'view' THEN '{{"timestamp":"' || {_ISO} || '",' || {_PERSON} || ',"action":"view","resource":"/item","ip":"10.0.0.' || {_USER} || '","event_id":' || {_ID} || '}}'
 WHEN 'click' THEN '{{"timestamp":"' || {_ISO} || '",' || {_PERSON} || ',"action":"process_start","device_id":"WS-' || {_USER} || '","event_id":' || {_ID} || '}}'
 ELSE '{{"event_id":' || {_ID} || ',"action":"SSH_BruteForce","props":' || props || '}}' END"""

SQL_JSON = f"j AS (SELECT event_id, event_type, {LOG_SOURCE} AS log_source, {JSON_LINE} AS line FROM events)"
SQL_LINES = f"l AS (SELECT *, {LOG_SOURCE} AS log_source, {LINE} AS line FROM events)"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def event_lines(spark, folder, line=LINE) -> DataFrame:
    """(event_id, event_type, log_source, value) with one line per event."""
    return table(spark, folder, "events").select(
        "event_id",
        "event_type",
        F.expr(LOG_SOURCE).alias("log_source"),
        F.expr(line).alias("value"),
    )


def json_lines(spark, folder) -> DataFrame:
    return event_lines(spark, folder, JSON_LINE)


def source_lines(spark, folder, source) -> DataFrame:
    """The lines of one source only; the choice reaches the scan as a filter."""
    kind = next(t for t, s in SOURCE_OF_TYPE.items() if s == source)
    events = table(spark, folder, "events").filter(F.col("event_type") == kind)
    return events.select(F.expr(LINE).alias("value"))


def document_lines(spark, folder) -> DataFrame:
    """(doc_id, source, pos, value): every line of every document."""
    return table(spark, folder, "documents").select(
        "doc_id", "source", F.posexplode(F.split("text", "\r\n|[\r\n]")).alias("pos", "value")
    )


SQL_DOC_LINES = (
    "d AS (SELECT doc_id, source, unnest(parts) AS value, "
    "unnest(generate_series(0, len(parts) - 1)) AS pos FROM "
    "(SELECT doc_id, source, string_split_regex(text, '\\r\\n|[\\r\\n]') AS parts FROM documents))"
)


def source_spec(name: str, **changes) -> SourceSpec:
    return SourceSpec(**{"name": name, "type": "file", **changes})
