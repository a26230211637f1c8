"""Whole runs: log files written from the tables, loaded, and what the store then holds."""

import uuid
from dataclasses import replace

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from logweir.operators.mapping import infer_rules, rules_as_xml
from logweir.operators.parse import parse_lines
from logweir.operators.totals import run_report, union_all
from logweir.constants import KEY_SYNONYMS_BASIC
from logweir.plans.ingest import file_reads, run_all, run_source
from logweir.plans.store import Store
from logweir.session import shared_folder, ship
from logweir.sinks.alerts import create_alert_table, insert_alerts
from logweir.sources.files import present_files, read_lines
from logweir.sources.rules import read_rules, write_rules
from logweir.sources.spec import SourceSpec
from logweir.sources.tail import kept_files, opened
from logweir.streaming.ingest import source_stream, start_loading
from logweir.workload.mapping import SQL as MAPPING_SQL
from logweir.workload.tables import (
    EVENT_TIME,
    LINE,
    LOG_SOURCE,
    SOURCE_OF_TYPE,
    SQL_LINES,
    event_lines,
    json_lines,
    source_spec,
    table,
)

# The error events as records whose time cannot be read.
_UNREADABLE = """'{"timestamp":"day ' || CAST(event_id AS STRING) || '","user_id":"' || CAST(user_id AS STRING) || '"}'"""

# Days 11 to 20 come first, then the later ones, then the earlier ones.
_GO_OF_DAY = "WHEN day(ts) BETWEEN 11 AND 20 THEN 0 WHEN day(ts) > 20 THEN 1 ELSE 2"

_MIDDLE = "TIMESTAMP '2024-01-16 00:00:00'"


def _new_folder(spark):
    return f"{shared_folder(spark)}/runs/{uuid.uuid4().hex}"


def _write_files(spark, folder, root):
    """Log files of all sources, written in one go; the specs that read them."""
    events = table(spark, folder, "events")
    line = f"CASE WHEN event_type = 'error' THEN {_UNREADABLE} ELSE {LINE} END"
    lines = events.select(F.expr(LOG_SOURCE).alias("log_source"), F.expr(line).alias("value"))
    lines.write.mode("overwrite").partitionBy("log_source").text(f"{root}/logs")
    return [source_spec(s, path=f"{root}/logs/log_source={s}") for s in SOURCE_OF_TYPE.values()]


def _run(spark, folder, cycles=1, **options):
    root = _new_folder(spark)
    store = Store(spark, f"{root}/store")
    specs = _write_files(spark, folder, root)
    for _ in range(cycles):
        run_all(spark, store, specs, **options)
    return store


def file_lines(spark, folder):
    """Lines written as files in two goes; what a second read adds to the first."""
    root = _new_folder(spark)
    spec = source_spec("all", path=f"{root}/logs/*")
    lines, store, read = event_lines(spark, folder), Store(spark, f"{root}/store"), []
    for seq, go in enumerate(("first", "second")):
        lines.filter(f"event_id % 2 = {seq}").select("value").write.text(f"{root}/logs/{go}")
        files = file_reads(store, spec, present_files(spark, spec), seq)
        read.append(read_lines(spark, spec, files).select(F.lit(go).alias("go"), F.md5("value").alias("line_md5")))
        store.save_files(spec.name, kept_files(files), seq)
    return read[0].unionByName(read[1])


# Lines without a time of their own: those of one user are all equal.
_TIMELESS = "'[allow] src=10.0.0.' || user_id || ' dst=10.0.9.1 dst_port=443 proto=TCP service=Web bytes=512'"


def _written_whole(folder):
    """Each task writes its lines as one file, over what an earlier try or version has written."""

    def run(batches):
        path = f"{folder}/part-{TaskContext.get().partitionId():05}.log"
        system, place = opened(path)
        system.create_dir(opened(folder)[1], recursive=True)
        n = 0
        with system.open_output_stream(f"{place}.tmp") as out:
            for batch in batches:
                lines = batch.column("value").to_pylist()
                out.write("".join(f"{line}\n" for line in lines).encode())
                n += len(lines)
        system.move(f"{place}.tmp", place)
        yield pa.record_batch([pa.array([n], pa.int64())], ["n"])

    return run


def _grow(lines, folder, upto):
    """Files that hold the lines of the goes up to one: those of the go before, with more behind them."""
    ship(lines.sparkSession)
    dealt = lines.filter(F.col("go") <= upto).repartition(8, "event_id").sortWithinPartitions("go", "event_id")
    dealt.select("value").mapInArrow(_written_whole(folder), "n long").agg(F.sum("n")).collect()


def _tailed(spark, folder, follow):
    """Files that grow twice, followed three times: alerts of each source address and day kept apart."""
    root = _new_folder(spark)
    store = Store(spark, f"{root}/store")
    spec = source_spec("Firewall_Logs", type="tail", path=f"{root}/logs/*.log")
    lines = table(spark, folder, "events").select("event_id", F.expr("event_id % 3").alias("go"), F.expr(_TIMELESS).alias("value"))
    for go in range(3):
        _grow(lines, f"{root}/logs", go)
        follow(store, spec, root, go)
    loads = store.history().filter("processed_count > 0").count()
    alerts = store.alerts.alerts()
    return alerts.groupBy("src_ip").agg(F.count(F.lit(1)).alias("n")).withColumn("loads", F.lit(loads).cast("bigint"))


def tailed_lines(spark, folder):
    """Batch runs read what the files have got since: each line once, equal ones without a time too."""
    return _tailed(spark, folder, lambda store, spec, root, go: run_source(spark, store, spec, seq=go))


def tailed_lines_in_stream(spark, folder):
    """The same by a stream that is started again from its checkpoint."""

    def follow(store, spec, root, go):
        start_loading(source_stream(spark, spec), store, spec, f"{root}/checkpoint", once=True).awaitTermination()

    return _tailed(spark, folder, follow)


def index_after_cycles(spark, folder):
    """Two cycles over the same files, merged between them, leave each alert once."""
    root = _new_folder(spark)
    store = Store(spark, f"{root}/store")
    specs = _write_files(spark, folder, root)
    run_all(spark, store, specs)
    store.merge(keep=0)
    run_all(spark, store, [replace(s, late_policy="allow", path=f"{s.path}/*") for s in specs])
    return store.alerts.documents().select(
        "final_ts", "log_source", "user_id", "action", "src_ip", "risk_score",
        F.coalesce("bytes_total", F.lit(-1.0)).alias("bytes_total"),
        F.col("event_date").cast("string").alias("event_date"),
    )


def notifications_after_cycle(spark, folder):
    store = _run(spark, folder, notify=True)
    return store.notifications.alerts().select("final_ts", "user_id", "action", "risk_score")


def rejects_after_cycle(spark, folder):
    store = _run(spark, folder)
    return store.alerts.rejects().select("user_id", "error_reason", "load_status")


def history_after_cycles(spark, folder):
    """The second cycle finds nothing new; the unreadable rows are counted as failed."""
    store = _run(spark, folder, cycles=2)
    return store.history().select("source_name", "processed_count", "failed_count", "status")


def lines_accounted_for(spark, folder):
    """Blank lines and lines that are late: all are counted, by source and load."""
    root = _new_folder(spark)
    store = Store(spark, f"{root}/store")
    specs = [replace(s, path=f"{s.path}/*") for s in _write_files(spark, folder, root)]
    run_all(spark, store, specs)
    again = table(spark, folder, "events").select(
        F.expr(LOG_SOURCE).alias("log_source"),
        F.expr(f"CASE WHEN event_id % 3 = 0 THEN ' ' ELSE {LINE} END").alias("value"),
    )
    again.write.mode("append").partitionBy("log_source").text(f"{root}/logs")
    run_all(spark, store, specs)
    sums = [F.sum(c).alias(c) for c in ("processed_count", "failed_count", "late_count", "blank_count")]
    return store.history().groupBy("source_name").agg(F.count(F.lit(1)).alias("loads"), *sums)


def report_after_cycle(spark, folder):
    store = _run(spark, folder)
    return run_report(store.history()).select("source_name", "target_index", "processed", "status_label")


def cursors_after_cycle(spark, folder):
    store = _run(spark, folder)
    cursors = [store.cursors(s).read() for s in SOURCE_OF_TYPE.values()]
    return union_all(cursors).select("source_name", "watermark_value", "watermark_type")


def cycle_with_learned_rules(spark, folder):
    """Rules learned from the files themselves and names from the catalog's people."""
    root = _new_folder(spark)
    store = Store(spark, f"{root}/store")
    lines = json_lines(spark, folder).select("log_source", "value")
    lines.write.partitionBy("log_source").text(f"{root}/written")
    specs = [source_spec(s, path=f"{root}/written/log_source={s}") for s in SOURCE_OF_TYPE.values()]
    people = f"people_{uuid.uuid4().hex}"
    table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("emp_id"), F.col("s_name").alias("emp_name")
    ).createOrReplaceTempView(people)
    specs.append(SourceSpec(name="people", type="table", table_name=people, people=True, enabled=False))
    learned = infer_rules(parse_lines(json_lines(spark, folder)).filter("log_source <> 'Error_Text'"))
    store.registry.upsert(rules_as_xml(learned).withColumn("updated_at", F.lit("2026-01-01").cast("timestamp_ntz")), 0)
    run_all(spark, store, specs)
    return store.alerts.alerts().filter("log_source <> 'people'").select(
        "log_source", F.when(~F.col("time_inferred"), F.col("final_ts")).alias("final_ts"), "user_id", "src_ip",
        F.col("extras")["mapped_name"].alias("mapped_name"),
    )


def personal_fields_left_out(spark, folder):
    """Lines that carry personal fields: neither the stored fields nor the id depend on them."""
    root = _new_folder(spark)
    store = Store(spark, f"{root}/store")
    plain = "'{\"timestamp\":\"' || " + EVENT_TIME + " || '\",\"user_id\":\"' || CAST(event_id AS STRING) || '\"'"
    told = plain + " || ',\"ssn\":\"' || CAST(user_id AS STRING) || '\",\"phone\":\"1\"'"
    for n, line in enumerate((plain, told)):
        table(spark, folder, "events").select(F.expr(line + " || '}'").alias("value")).write.text(f"{root}/logs/{n}")
        run_all(spark, store, [source_spec("Auth_Logs", path=f"{root}/logs/{n}", late_policy="allow")])
    rows = store.alerts.alerts()
    return rows.select(F.col("user_id").cast("bigint").alias("event_id"), F.size("extras").cast("bigint").alias("n_extras"))


def registry_after_learning(spark, folder):
    """Documents learned with few synonyms, then replaced by those learned with all."""
    store = Store(spark, _new_folder(spark))
    records = parse_lines(json_lines(spark, folder))
    few = infer_rules(records, synonyms=KEY_SYNONYMS_BASIC)
    now = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    for version, rules in enumerate((few, infer_rules(records))):
        store.registry.upsert(rules_as_xml(rules).withColumn("updated_at", now), version)
    return store.registry.read().select("source_name", "parser_xml")


def table_after_inserts(spark, folder):
    """The relational table takes a batch once; a second batch adds only null keys, a retry nothing."""
    root = _new_folder(spark)
    name = "alert_rows_" + root.rsplit("/", 1)[1].replace("-", "")
    create_alert_table(spark, name, path=f"{root}/table")
    batch = table(spark, folder, "events").select(
        F.expr(EVENT_TIME).alias("final_ts"),
        F.when(F.col("event_type") != "error", F.col("event_id").cast("string")).alias("emp_id"),
        F.lit("10.0.0.1").alias("src_ip"),
        F.expr(LOG_SOURCE).alias("log_source"),
        F.col("event_type").alias("action"),
        F.col("value").alias("risk_score"),
    )
    for seq in (1, 2, 2):
        insert_alerts(spark, name, batch, f"{root}/staging", seq)
    return spark.table(name).groupBy("log_source", "action").agg(F.count(F.lit(1)).alias("n"))


def _halves(spark, folder, late_policy):
    """The second half of January is loaded first; the first half then comes late."""
    root = _new_folder(spark)
    store = Store(spark, f"{root}/store")
    specs = [source_spec(s, path=f"{root}/logs/*/log_source={s}", late_policy=late_policy) for s in SOURCE_OF_TYPE.values()]
    for half, kept in (("second", f"ts >= {_MIDDLE}"), ("first", f"ts < {_MIDDLE}")):
        lines = table(spark, folder, "events").filter(kept).select(F.expr(LOG_SOURCE).alias("log_source"), F.expr(LINE).alias("value"))
        lines.write.partitionBy("log_source").text(f"{root}/logs/{half}")
        run_all(spark, store, specs)
    return store.alerts.alerts().select("final_ts", "log_source", "src_ip", "risk_score")


def late_rows_by_watermark(spark, folder):
    """Files that come out of order, in a stream started again for each: kept, late and counted rows.

    First the middle days of the month, then the newest, then the oldest: of these only rows up
    to 25 days behind the newest one before are kept.
    """
    root = _new_folder(spark)
    store = Store(spark, f"{root}/store")
    spec = source_spec("Auth_Logs", path=f"{root}/logs/*", late_policy="watermark", late_delay="25 days")
    lines = table(spark, folder, "events").filter("event_type = 'signup'").select(
        F.expr(f"CASE {_GO_OF_DAY} END").alias("go"), F.expr(LINE).alias("value")
    )
    for go in range(3):
        lines.filter(F.col("go") == go).select("value").write.text(f"{root}/logs/{go}")
        for _ in range(2):  # the second start finds nothing new
            start_loading(source_stream(spark, spec), store, spec, f"{root}/checkpoint", once=True).awaitTermination()
    kept = store.alerts.alerts().groupBy(F.to_date("final_ts").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    late = store.history().agg(F.sum("late_count").alias("n")).select(F.lit("late").alias("day"), "n")
    return kept.unionByName(late)


def late_rows_dropped(spark, folder):
    return _halves(spark, folder, "drop")


def late_rows_kept(spark, folder):
    return _halves(spark, folder, "allow")


def failing_source_alone(spark, folder):
    """A source that cannot be read is recorded; the others are loaded."""
    root = _new_folder(spark)
    store = Store(spark, f"{root}/store")
    run_all(spark, store, [source_spec("Broken", type="no_such_type"), *_write_files(spark, folder, root)])
    return store.history().select("source_name", "status", "processed_count")


def rules_from_files(spark, folder):
    """Learned documents written as files and read back as rules."""
    root = _new_folder(spark)
    write_rules(rules_as_xml(infer_rules(parse_lines(json_lines(spark, folder)))), f"{root}/rules")
    rules = read_rules(spark, f"{root}/rules")
    return rules.select("log_source", F.col("pos").cast("bigint").alias("pos"), "target", "source")


QUERIES = {
    "late_rows_by_watermark": late_rows_by_watermark,
    "tailed_lines": tailed_lines,
    "tailed_lines_in_stream": tailed_lines_in_stream,
    "late_rows_dropped": late_rows_dropped,
    "late_rows_kept": late_rows_kept,
    "failing_source_alone": failing_source_alone,
    "rules_from_files": rules_from_files,
    "file_lines": file_lines,
    "lines_accounted_for": lines_accounted_for,
    "cycle_with_learned_rules": cycle_with_learned_rules,
    "personal_fields_left_out": personal_fields_left_out,
    "index_after_cycles": index_after_cycles,
    "notifications_after_cycle": notifications_after_cycle,
    "rejects_after_cycle": rejects_after_cycle,
    "history_after_cycles": history_after_cycles,
    "report_after_cycle": report_after_cycle,
    "cursors_after_cycle": cursors_after_cycle,
    "registry_after_learning": registry_after_learning,
    "table_after_inserts": table_after_inserts,
}

_SHOWN = f"replace({EVENT_TIME}, ' ', 'T') || '+09:00' AS final_ts"
_THREAT = "event_type = 'purchase' AND value > 100"
_SRC = """CASE event_type WHEN 'purchase' THEN '10.0.1.' || user_id WHEN 'signup' THEN '10.0.0.' || user_id
 WHEN 'view' THEN '10.0.0.' || user_id ELSE 'Internal' END"""

_ALL = (
    f"SELECT date_trunc('second', ts) AS final_ts, {LOG_SOURCE} AS log_source, {_SRC} AS src_ip, "
    f"CASE WHEN {_THREAT} THEN 95.0 ELSE 10.0 END::DOUBLE AS risk_score FROM events"
)
_COUNTED = f"""c AS (SELECT {LOG_SOURCE} AS source_name, event_type,
 count(*) FILTER (event_type <> 'error') AS loaded, count(*) FILTER (event_type = 'error') AS bad FROM events GROUP BY event_type)"""

_TAILED = "SELECT '10.0.0.' || user_id AS src_ip, count(*) AS n, 3::BIGINT AS loads FROM events GROUP BY user_id"

SQL = {
    "late_rows_by_watermark": f"""WITH e AS (SELECT date_trunc('second', ts) AS t, CASE {_GO_OF_DAY} END AS go
  FROM events WHERE event_type = 'signup'),
 bounds AS (SELECT g.go, max(e.t) - INTERVAL 25 DAYS AS bound FROM (VALUES (0), (1), (2)) g(go) LEFT JOIN e ON e.go < g.go GROUP BY g.go),
 judged AS (SELECT e.*, coalesce(e.t < b.bound, false) AS late FROM e JOIN bounds b USING (go))
SELECT CAST(CAST(t AS DATE) AS VARCHAR) AS day, count(*) AS n FROM judged WHERE NOT late GROUP BY 1
UNION ALL SELECT 'late', count(*) FILTER (late) FROM judged""",
    "tailed_lines": _TAILED,
    "tailed_lines_in_stream": _TAILED,
    "late_rows_dropped": f"{_ALL} WHERE ts >= {_MIDDLE}",
    "late_rows_kept": _ALL,
    "failing_source_alone": f"""WITH {_COUNTED} SELECT 'Broken' AS source_name, 'FAIL' AS status, 0 AS processed_count
UNION ALL SELECT source_name, 'SUCCESS', loaded FROM c""",
    "rules_from_files": MAPPING_SQL["infer_mapping"],
    "file_lines": f"""WITH {SQL_LINES} SELECT CASE event_id % 2 WHEN 0 THEN 'first' ELSE 'second' END AS go,
 md5(line) AS line_md5 FROM l""",
    "index_after_cycles": f"""WITH {SQL_LINES} SELECT {_SHOWN}, log_source,
 CASE event_type WHEN 'click' THEN CAST(user_id AS VARCHAR) WHEN 'view' THEN 'Unknown_ID' ELSE 'user ' || user_id END AS user_id,
 CASE WHEN event_type = 'click' THEN 'process_start' WHEN event_type = 'signup' THEN 'login'
  WHEN event_type = 'view' THEN 'Unknown_Action' WHEN {_THREAT} THEN 'Massive_FTP_Exfiltration' ELSE 'allow' END AS action,
 {_SRC} AS src_ip, CASE WHEN {_THREAT} THEN 95.0 ELSE 10.0 END::DOUBLE AS risk_score,
 CASE WHEN event_type = 'purchase' THEN event_id ELSE -1.0 END::DOUBLE AS bytes_total,
 substring(CAST(ts AS VARCHAR), 1, 10) AS event_date
FROM l WHERE event_type <> 'error'""",
    "notifications_after_cycle": f"""SELECT date_trunc('second', ts) AS final_ts, 'user ' || user_id AS user_id,
 'Massive_FTP_Exfiltration' AS action, 95.0::DOUBLE AS risk_score FROM events WHERE {_THREAT}""",
    "rejects_after_cycle": """SELECT CAST(user_id AS VARCHAR) AS user_id,
 'final_ts: not a time: day ' || event_id AS error_reason, 'rejected' AS load_status
FROM events WHERE event_type = 'error'""",
    "history_after_cycles": f"""WITH {_COUNTED}
SELECT source_name, loaded AS processed_count, bad AS failed_count, 'SUCCESS' AS status FROM c
UNION ALL SELECT source_name, 0, 0, 'SUCCESS' FROM c""",
    "lines_accounted_for": f"""WITH g AS (SELECT {LOG_SOURCE} AS source_name, event_type, event_id % 3 = 0 AS blank FROM events)
SELECT source_name, 2 AS loads, count(*) FILTER (event_type <> 'error' OR NOT blank) AS processed_count,
 count(*) FILTER (event_type = 'error') AS failed_count,
 count(*) FILTER (event_type <> 'error' AND NOT blank) AS late_count, count(*) FILTER (blank) AS blank_count
FROM g GROUP BY source_name""",
    "cycle_with_learned_rules": f"""WITH n AS (SELECT events.*, s_name FROM events LEFT JOIN supplier ON user_id = s_suppkey)
SELECT {LOG_SOURCE} AS log_source, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS final_ts,
 CASE WHEN event_type = 'error' THEN 'Unknown_ID' ELSE 'user ' || user_id END AS user_id, CASE event_type WHEN 'signup' THEN '10.0.0.' || user_id WHEN 'view' THEN '10.0.0.' || user_id
  WHEN 'purchase' THEN '10.0.1.' || user_id ELSE 'Internal' END AS src_ip,
 CASE WHEN event_type <> 'error' THEN coalesce(s_name, 'Unknown_User') END AS mapped_name FROM n""",
    "personal_fields_left_out": "SELECT event_id, 0 AS n_extras FROM events",
    "report_after_cycle": f"""WITH {_COUNTED} SELECT source_name, 'alerts' AS target_index,
 format('{{:,}}', loaded) || ' 건' AS processed, '✅ 성공' AS status_label FROM c""",
    "cursors_after_cycle": f"""SELECT {LOG_SOURCE} AS source_name,
 CASE WHEN event_type = 'error' THEN '1970-01-01 00:00:00' ELSE max({EVENT_TIME}) END AS watermark_value,
 'timestamp_ntz' AS watermark_type FROM events GROUP BY event_type""",
    "registry_after_learning": MAPPING_SQL["mapping_documents"],
    "table_after_inserts": f"""SELECT {LOG_SOURCE} AS log_source, event_type AS action,
 count(*) * CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS n FROM events GROUP BY event_type""",
}
