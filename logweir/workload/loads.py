"""Keyed loads, conforming, rejects, and the streaming load."""

import uuid

from pyspark.sql import functions as F

from logweir.operators.keyed import (
    alert_document,
    conform,
    document_id,
    insert_unique,
    latest_per_key,
    load_counts,
    upsert,
    with_load_error,
)
from logweir.operators.parse import nonblank_lines
from logweir.operators.totals import union_all
from logweir.plans.store import Store
from logweir.schemas import alert_table
from logweir.session import shared_folder
from logweir.sinks.alerts import AlertIndex, write_json_lines
from logweir.sources.files import present_files, read_lines
from logweir.sources.tail import head_lines
from logweir.streaming.ingest import start_all, start_loading
from logweir.functions.text import WHITESPACE
from logweir.workload.tables import (
    LINE,
    LOG_SOURCE,
    SOURCE_OF_TYPE,
    SQL_DOC_LINES,
    SQL_LINES,
    document_lines,
    event_lines,
    json_lines,
    source_spec,
    table,
)

_SPLIT = "2024-01-20"


def _versions(spark, folder):
    events = table(spark, folder, "events")
    rows = events.select("user_id", "event_type", F.col("event_id").alias("version"), "value")
    late = F.col("ts") >= F.lit(_SPLIT).cast("timestamp_ntz")
    return rows.filter(~late), rows.filter(late).withColumn("note", F.lit("batch"))


def upsert_latest(spark, folder):
    """Stored rows and a batch: the highest version of a key stands."""
    target, batch = _versions(spark, folder)
    return upsert(target, batch, ["user_id", "event_type"], "version")


def upsert_by_document_id(spark, folder):
    rows = table(spark, folder, "lineitem").withColumn(
        "doc_id", document_id(["l_returnflag", "l_suppkey"])
    )
    order = [F.col(c).desc() for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")]
    latest = latest_per_key(rows, ["doc_id"], order)
    return latest.select("doc_id", "l_orderkey", "l_linenumber", "l_partkey")


def _keyed(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        F.to_date("ts").cast("timestamp_ntz").alias("final_ts"),
        F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias("emp_id"),
        F.concat(F.lit("10.0.0."), F.col("user_id").cast("string")).alias("src_ip"),
        F.col("event_type").alias("log_source"),
    )


def insert_first_per_key(spark, folder):
    """First row per key within a batch; rows with a null key part all pass."""
    return insert_unique(_keyed(spark, folder), [F.col("event_id")])


def insert_new_keys(spark, folder):
    """The same against a table that already holds the clicks and signups."""
    rows = _keyed(spark, folder)
    return insert_unique(rows, [F.col("event_id")], rows.filter("log_source IN ('click', 'signup')"))


def _loose(spark, folder):
    """Text in place of numbers and times, as loads get it; some of it malformed."""
    bad = F.col("event_type") == "error"
    number = F.col("event_id").cast("string")
    return table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") == "view", "no time")
        .otherwise(F.col("ts").cast("string"))
        .alias("final_ts"),
        F.when(bad, F.concat(F.lit("x"), number)).otherwise(number).alias("bytes_total"),
        F.when(F.col("event_type") != "click", F.lit("443")).alias("dst_port"),
        F.col("value").cast("string").alias("risk_score"),
        F.lit("Web_Logs").alias("log_source"),
        F.col("event_type").alias("action"),
    )


def conform_to_table(spark, folder):
    """The relational alert table: typed where possible, null elsewhere."""
    rows = conform(_loose(spark, folder), alert_table(), F.lit("2026-01-01 00:00:00"))
    # counted columns are shown as text: a missing number has one form in both engines
    return rows.select(
        "final_ts", "log_source", "action", "risk_score", "user_id", "created_at",
        F.col("bytes_total").cast("string").alias("bytes_total"),
        F.col("dst_port").cast("string").alias("dst_port"),
    )


def sink_documents(spark, folder):
    rows = _loose(spark, folder)
    typed = rows.withColumn("final_ts", F.col("final_ts").try_cast("timestamp_ntz"))
    return alert_document(typed)


_CASTS = {"final_ts": "timestamp_ntz", "bytes_total": "double", "risk_score": "double"}


def rejected_rows(spark, folder):
    rows = with_load_error(_loose(spark, folder), _CASTS)
    return rows.filter(F.col("error_reason").isNotNull()).select("event_id", "error_reason")


def count_loads(spark, folder):
    return load_counts(with_load_error(_loose(spark, folder), _CASTS))


def _run_folder(spark):
    return f"{shared_folder(spark)}/runs/{uuid.uuid4().hex}"


def first_load_errors(spark, folder):
    """The sample of reasons that a load logs."""
    index = AlertIndex(spark, f"{_run_folder(spark)}/alerts")
    rows = with_load_error(_loose(spark, folder), _CASTS).select(
        F.md5(F.col("event_id").cast("string")).alias("row_id"),
        F.col("final_ts").try_cast("timestamp_ntz").alias("final_ts"), "error_reason",
    )
    index.put(rows, "Web_Logs", 1)
    return index.first_errors("Web_Logs", 1)


def raw_json_lines(spark, folder):
    """Rows written as raw lines, and what the files then hold."""
    path = f"{_run_folder(spark)}/lines"
    write_json_lines(table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment"), path)
    return spark.read.text(path)


def first_line_per_document(spark, folder):
    """The first line of each document, stripped; documents that start blank give none."""
    lines = document_lines(spark, folder)
    first = lines.groupBy("doc_id").agg(F.min_by("value", "pos").alias("value"))
    return nonblank_lines(first).select("doc_id", F.md5("line").alias("line_md5"))


def first_line_per_file(spark, folder):
    """Documents written as many files of each source: the first line of each, stripped, unless blank."""
    path = f"{_run_folder(spark)}/documents"
    lines = document_lines(spark, folder).select("source", F.expr("doc_id DIV 10000").alias("bucket"), "doc_id", "pos", "value")
    parted = lines.repartition("source", "bucket").sortWithinPartitions("source", "bucket", "doc_id", "pos")
    writer = parted.select("source", "bucket", "value").write.option("maxRecordsPerFile", 0)
    writer.partitionBy("source", "bucket").text(path)
    heads = nonblank_lines(head_lines(present_files(spark, source_spec("all", path=f"{path}/*/*"))))
    named = [F.regexp_extract("path", f"{name}=([^/]+)/", 1) for name in ("source", "bucket")]
    return heads.select(named[0].alias("source"), named[1].cast("bigint").alias("bucket"), F.md5("line").alias("line_md5"))


def concat_line_files(spark, folder):
    """Two renderings of each source, written as files, read as one input."""
    path = _run_folder(spark)
    for name, lines in (("lines", event_lines(spark, folder)), ("records", json_lines(spark, folder))):
        lines.select("log_source", "value").write.partitionBy("log_source").text(f"{path}/{name}")
    frames = [
        nonblank_lines(read_lines(spark, source_spec(s, path=f"{path}/*/log_source={s}"))).withColumn("log_source", F.lit(s))
        for s in SOURCE_OF_TYPE.values()
    ]
    return union_all(frames).groupBy("log_source").agg(F.count(F.lit(1)).alias("n"))


def _stream_of_lines(spark, folder):
    schema = table(spark, folder, "events").schema
    events = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    )
    return events.select(F.expr(LINE).alias("value"))


def stream_alerts_in_pieces(spark, folder):
    """All sources from one file per ten days, a file in a batch, late rows dropped: none is."""
    root = _run_folder(spark)
    store = Store(spark, f"{root}/store")
    period = F.floor(F.dayofmonth("ts") / 10)
    lines = table(spark, folder, "events").select(
        F.expr(LOG_SOURCE).alias("log_source"), period.alias("period"), F.expr(LINE).alias("value")
    )
    # the last ten days are the first files, so that each batch is older than the one before
    lines = lines.withColumn("period", 9 - F.col("period")).repartition("log_source", "period")
    lines.write.partitionBy("log_source", "period").text(f"{root}/logs")
    specs = [source_spec(s, path=f"{root}/logs/log_source={s}/*") for s in SOURCE_OF_TYPE.values()]
    queries = start_all(spark, store, specs, f"{root}/checkpoint", limits={"max_files": 1}, once=True)
    for query in queries.values():
        query.awaitTermination()
    return store.alerts.alerts().groupBy("log_source", "event_date").agg(
        F.count(F.lit(1)).alias("n"), F.min("final_ts").alias("first"), F.max("final_ts").alias("last")
    ).withColumn("event_date", F.col("event_date").cast("string"))


def stream_alerts(spark, folder):
    """The lines of all events as a stream, loaded until done; the index it leaves."""
    root = _run_folder(spark)
    store = Store(spark, f"{root}/store")
    spec = source_spec("Endpoint_Logs", late_policy="allow")
    query = start_loading(_stream_of_lines(spark, folder), store, spec, f"{root}/checkpoint", once=True)
    query.awaitTermination()
    return store.alerts.alerts().select(
        "final_ts", "user_id", "action", "src_ip", "log_source", "raw_message", "risk_score"
    )


QUERIES = {
    "upsert_latest": upsert_latest,
    "upsert_by_document_id": upsert_by_document_id,
    "insert_first_per_key": insert_first_per_key,
    "insert_new_keys": insert_new_keys,
    "conform_to_table": conform_to_table,
    "sink_documents": sink_documents,
    "rejected_rows": rejected_rows,
    "count_loads": count_loads,
    "first_load_errors": first_load_errors,
    "raw_json_lines": raw_json_lines,
    "first_line_per_document": first_line_per_document,
    "first_line_per_file": first_line_per_file,
    "concat_line_files": concat_line_files,
    "stream_alerts": stream_alerts,
    "stream_alerts_in_pieces": stream_alerts_in_pieces,
}

_SQL_KEYED = """k AS (SELECT event_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS final_ts,
 CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS emp_id,
 '10.0.0.' || user_id AS src_ip, event_type AS log_source FROM events),
 f AS (SELECT *, row_number() OVER (PARTITION BY final_ts, emp_id, src_ip, log_source ORDER BY event_id) AS r FROM k)"""
_SQL_LOOSE = """l AS (SELECT event_id, CASE WHEN event_type = 'view' THEN 'no time' ELSE CAST(ts AS VARCHAR) END AS final_ts,
 CASE WHEN event_type = 'error' THEN 'x' || event_id ELSE CAST(event_id AS VARCHAR) END AS bytes_total,
 CASE WHEN event_type <> 'click' THEN '443' END AS dst_port, CAST(value AS VARCHAR) AS risk_score,
 'Web_Logs' AS log_source, event_type AS action FROM events)"""
_SQL_REASON = """CASE WHEN TRY_CAST(bytes_total AS DOUBLE) IS NULL THEN 'bytes_total: not a double: ' || bytes_total
 WHEN TRY_CAST(final_ts AS TIMESTAMP) IS NULL THEN 'final_ts: not a timestamp_ntz: ' || final_ts END AS error_reason"""

_SPACE = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)

SQL = {
    "stream_alerts_in_pieces": f"""WITH t AS (SELECT {LOG_SOURCE} AS log_source, date_trunc('second', ts) AS s FROM events)
SELECT log_source, substring(CAST(s AS VARCHAR), 1, 10) AS event_date, count(*) AS n, min(s) AS "first", max(s) AS "last"
FROM t GROUP BY 1, 2""",
    "first_line_per_document": f"""WITH {SQL_DOC_LINES}, t AS (SELECT doc_id, trim(value, {_SPACE}) AS line
 FROM d WHERE pos = 0) SELECT doc_id, md5(line) AS line_md5 FROM t WHERE line <> ''""",
    "first_line_per_file": f"""WITH {SQL_DOC_LINES}, t AS (SELECT source, doc_id // 10000 AS bucket, trim(value, {_SPACE}) AS line
 FROM d QUALIFY row_number() OVER (PARTITION BY source, doc_id // 10000 ORDER BY doc_id, pos) = 1)
SELECT source, bucket, md5(line) AS line_md5 FROM t WHERE line <> ''""",
    "stream_alerts": f"""WITH {SQL_LINES}, t AS (SELECT *, CAST(substring(CAST(ts AS VARCHAR), 1, 19) AS TIMESTAMP) AS final_ts FROM l)
SELECT final_ts, CASE event_type WHEN 'click' THEN CAST(user_id AS VARCHAR) WHEN 'signup' THEN 'user ' || user_id
  WHEN 'purchase' THEN 'user ' || user_id ELSE 'Unknown_ID' END AS user_id,
 CASE event_type WHEN 'click' THEN 'process_start' WHEN 'signup' THEN 'login'
  WHEN 'purchase' THEN CASE WHEN value > 100 THEN 'Massive_FTP_Exfiltration' ELSE 'allow' END
  ELSE 'Unknown_Action' END AS action,
 CASE WHEN event_type = 'purchase' THEN '10.0.1.' || user_id ELSE 'Internal' END AS src_ip,
 'Endpoint_Logs' AS log_source, CASE WHEN event_type IN ('view', 'error') THEN line END AS raw_message,
 CASE WHEN event_type = 'purchase' AND value > 100 THEN 95.0 ELSE 10.0 END::DOUBLE AS risk_score FROM t""",
    "upsert_latest": f"""WITH b AS (SELECT user_id, event_type, event_id AS version, value,
 CASE WHEN ts >= TIMESTAMP '{_SPLIT}' THEN 'batch' END AS note FROM events)
SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY version DESC) = 1""",
    "upsert_by_document_id": """SELECT l_returnflag || '_' || l_suppkey AS doc_id, l_orderkey, l_linenumber, l_partkey
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_returnflag, l_suppkey
 ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC) = 1""",
    "insert_first_per_key": f"WITH {_SQL_KEYED} SELECT event_id, final_ts, emp_id, src_ip, log_source "
    "FROM f WHERE emp_id IS NULL OR r = 1",
    "insert_new_keys": f"WITH {_SQL_KEYED} SELECT event_id, final_ts, emp_id, src_ip, log_source "
    "FROM f WHERE emp_id IS NULL OR (r = 1 AND log_source NOT IN ('click', 'signup'))",
    "conform_to_table": f"""WITH {_SQL_LOOSE} SELECT TRY_CAST(final_ts AS TIMESTAMP) AS final_ts, log_source, action,
 TRY_CAST(risk_score AS DOUBLE) AS risk_score, CAST(NULL AS VARCHAR) AS user_id,
 TIMESTAMP '2026-01-01 00:00:00' AS created_at,
 CAST(TRY_CAST(bytes_total AS BIGINT) AS VARCHAR) AS bytes_total,
 CAST(TRY_CAST(dst_port AS INTEGER) AS VARCHAR) AS dst_port FROM l""",
    "sink_documents": f"""WITH {_SQL_LOOSE} SELECT event_id,
 strftime(TRY_CAST(final_ts AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S') || '+09:00' AS final_ts,
 coalesce(TRY_CAST(bytes_total AS DOUBLE), 0.0) AS bytes_total, coalesce(TRY_CAST(dst_port AS DOUBLE), 0.0) AS dst_port,
 coalesce(TRY_CAST(risk_score AS DOUBLE), 0.0) AS risk_score, log_source, action FROM l""",
    "rejected_rows": f"WITH {_SQL_LOOSE}, e AS (SELECT event_id, {_SQL_REASON} FROM l) "
    "SELECT * FROM e WHERE error_reason IS NOT NULL",
    "count_loads": f"""WITH {_SQL_LOOSE}, e AS (SELECT event_id, {_SQL_REASON} FROM l)
SELECT count(*) FILTER (error_reason IS NULL) AS loaded, count(*) FILTER (error_reason IS NOT NULL) AS failed FROM e""",
    "first_load_errors": f"WITH {_SQL_LOOSE}, e AS (SELECT md5(CAST(event_id AS VARCHAR)) AS row_id, {_SQL_REASON} FROM l) "
    "SELECT * FROM e WHERE error_reason IS NOT NULL ORDER BY row_id LIMIT 3",
    "raw_json_lines": """SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"' ||
 c_mktsegment || '"}' AS value FROM customer""",
    "concat_line_files": """SELECT CASE event_type WHEN 'signup' THEN 'Auth_Logs' WHEN 'view' THEN 'Web_Logs'
 WHEN 'click' THEN 'Endpoint_Logs' WHEN 'purchase' THEN 'Firewall_Logs' ELSE 'Error_Text' END AS log_source,
 2 * count(*) AS n FROM events GROUP BY ALL""",
}
