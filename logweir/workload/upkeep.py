"""What happens to a store beside its loads: clearing, failures, names and rules that change."""

import uuid

from pyspark.sql import functions as F

from logweir.operators.behaviour import behaviour_scores, day_profiles, merged_profiles, score_behaviour
from logweir.operators.mapping import rules_as_xml
from logweir.plans.events import prepared_lookup
from logweir.plans.ingest import run_source
from logweir.plans.store import Store
from logweir.session import shared_folder
from logweir.sinks.alerts import create_alert_table, insert_alerts, truncate_table
from logweir.streaming.ingest import source_stream, start_loading
from logweir.workload.tables import EVENT_TIME, LINE, LOG_SOURCE, SOURCE_OF_TYPE, event_lines, source_spec, table


def _new_folder(spark):
    return f"{shared_folder(spark)}/runs/{uuid.uuid4().hex}"


def index_after_clear(spark, folder):
    """A load, merged, and a second one; cleared; then a third, and the first once more: the third's rows alone."""
    root = _new_folder(spark)
    store = Store(spark, f"{root}/store")
    lines = table(spark, folder, "events").filter("event_type = 'signup'")
    for go in range(3):
        lines.filter(f"event_id % 3 = {go}").select(F.expr(LINE).alias("value")).write.text(f"{root}/logs/{go}")

    def load(go):
        spec = source_spec("Auth_Logs", path=f"{root}/logs/{go}", late_policy="allow")
        run_source(spark, store, spec, seq=go)

    load(0)
    store.alerts.merge(keep=0)
    load(1)
    store.alerts.clear()
    load(2)
    load(0)
    return store.alerts.alerts().select("final_ts", "log_source", "src_ip")


def table_after_truncate(spark, folder):
    """The relational table takes a batch, is emptied, and takes the next one."""
    root = _new_folder(spark)
    name = "alert_rows_" + root.rsplit("/", 1)[1]
    create_alert_table(spark, name, path=f"{root}/table")
    batch = table(spark, folder, "events").select(
        F.expr(EVENT_TIME).alias("final_ts"),
        F.col("event_id").cast("string").alias("emp_id"),
        F.lit("10.0.0.1").alias("src_ip"),
        F.expr(LOG_SOURCE).alias("log_source"),
        F.col("event_type").alias("action"),
    )
    insert_alerts(spark, name, batch, f"{root}/staging", 1)
    truncate_table(spark, name)
    insert_alerts(spark, name, batch.filter("CAST(emp_id AS BIGINT) % 2 = 0"), f"{root}/staging", 2)
    return spark.table(name).groupBy("log_source", "action").agg(F.count(F.lit(1)).alias("n"))


class _Failing(Store):
    """Fails once after the rows are written, before the cursor moves."""

    failed = False

    def save_cursor(self, *args):
        if not self.failed:
            self.failed = True
            raise OSError("lost")
        super().save_cursor(*args)


def loads_after_failure(spark, folder):
    """A load that fails after its rows are written, lines without a time among them, and is run again."""
    root = _new_folder(spark)
    store = _Failing(spark, f"{root}/store")
    kinds = [t for t in SOURCE_OF_TYPE if t in ("signup", "error")]
    lines = table(spark, folder, "events").filter(F.col("event_type").isin(kinds))
    line = "CASE event_type WHEN 'error' THEN '{\"action\":\"error\"}' ELSE " + LINE + " END"
    lines.select(F.expr(line).alias("value")).write.text(f"{root}/logs")
    spec = source_spec("Auth_Logs", path=f"{root}/logs")
    for _ in range(2):
        try:
            run_source(spark, store, spec, seq=1)
        except OSError:
            continue
    rows = store.alerts.alerts().groupBy("action").agg(F.count(F.lit(1)).alias("n"))
    runs = store.history().select(F.col("status").alias("action"), F.col("processed_count").alias("n"))
    return rows.unionByName(runs)


def stream_follows_names_and_rules(spark, folder):
    """Names and rules that change between two micro-batches, then the first batch once more.

    Each row has the name and the mapping of its batch, also after the repeat.
    """
    root = _new_folder(spark)
    store = Store(spark, f"{root}/store")
    people = table(spark, folder, "supplier")

    def now(go, name, source):
        rows = people.select(F.col("s_suppkey").cast("string").alias("emp_id"), F.expr(name).alias("emp_name"))
        prepared_lookup(rows, f"{root}/store/people/{go}")
        store.save_people(f"{root}/store/people/{go}", go)
        rules = spark.createDataFrame([("Auth_Logs", 0, "src_ip", source)], "log_source string, pos int, target string, source string")
        store.registry.upsert(rules_as_xml(rules).withColumn("updated_at", F.lit("2026-01-01").cast("timestamp_ntz")), go)

    def run(path, checkpoint):
        spec = source_spec("Auth_Logs", path=path, late_policy="allow")
        query = start_loading(source_stream(spark, spec), store, spec, f"{root}/{checkpoint}", once=True, follow=True)
        query.awaitTermination()

    lines = event_lines(spark, folder).filter("event_type = 'signup'")
    for go, (name, source) in enumerate((("s_name", "ip"), ("upper(s_name)", "department"))):
        now(go, name, source)
        lines.filter(f"event_id % 2 = {go}").select("value").write.text(f"{root}/logs/{go}")
        run(f"{root}/logs/*", "checkpoint")
    run(f"{root}/logs/0", "repeated")  # its first batch has the number of the first load
    shown = F.col("extras")["event_id"].cast("bigint").alias("event_id")
    return store.alerts.alerts().select(shown, "src_ip", "emp_name")


def stream_stores_lines_once(spark, folder):
    """Two micro-batches of files that share a third of their lines, the stream started again between them.

    The rows in the files of the loads: shared lines once, those without a time as often as they came.
    """
    root = _new_folder(spark)
    store = Store(spark, f"{root}/store")
    spec = source_spec("Auth_Logs", path=f"{root}/logs/*", late_policy="allow", distinct_within="1 day")
    line = "CASE event_type WHEN 'error' THEN '{\"action\":\"error\"}' ELSE " + LINE + " END"
    lines = table(spark, folder, "events").filter("event_type IN ('signup', 'error')")
    for go in range(2):
        lines.filter(f"event_id % 3 IN ({go}, {go + 1})").select(F.expr(line).alias("value")).write.text(f"{root}/logs/{go}")
        start_loading(source_stream(spark, spec), store, spec, f"{root}/checkpoint", once=True).awaitTermination()
    stored = store.alerts.open_rows().filter("load_status = 'loaded'")
    return stored.groupBy("action", F.to_date("final_ts").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "day", F.when(F.col("action") != "error", F.col("day"))
    )


def _behaviour(spark, folder):
    """Users' events as scored rows, and the days' scores from the profiles of three loads."""
    store = Store(spark, f"{_new_folder(spark)}/store")
    events = table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        F.to_date("ts").alias("event_date"),
        F.col("event_type").alias("action"),
        F.col("value").alias("bytes_total"),
    )
    for go in range(3):
        store.profiles.put(day_profiles(events.filter(f"event_id % 3 = {go}")), "events", go)
    return events, behaviour_scores(merged_profiles(store.profiles.open_rows()))


def behaviour_by_day(spark, folder):
    """Each user's days against the fourteen days before, from sketches that three loads have kept."""
    scores = _behaviour(spark, folder)[1]
    rounded = {c: F.round(c, 9) for c in ("amount_rank", "behaviour_score")}
    return scores.withColumns(rounded).withColumn("event_date", F.col("event_date").cast("string"))


def alerts_by_behaviour(spark, folder):
    """Events of days that stand out get the model's score and message."""
    rows = score_behaviour(*_behaviour(spark, folder))
    return rows.select("event_id", F.round("risk_score", 6).alias("risk_score"), "alert_message")


QUERIES = {
    "index_after_clear": index_after_clear,
    "table_after_truncate": table_after_truncate,
    "loads_after_failure": loads_after_failure,
    "stream_follows_names_and_rules": stream_follows_names_and_rules,
    "stream_stores_lines_once": stream_stores_lines_once,
    "behaviour_by_day": behaviour_by_day,
    "alerts_by_behaviour": alerts_by_behaviour,
}

# Exact counterparts: the amounts before a day are listed, not sketched.
_SCORES = """e AS (SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, CAST(ts AS DATE) AS event_date, event_type, value FROM events),
 p AS (SELECT user_id, event_date, count(*) AS n, count(DISTINCT event_type) AS n_kinds, max(value) AS top FROM e GROUP BY ALL),
 b AS (SELECT p.user_id, p.event_date, count(e.event_id) AS base_n, count(e.value) AS amounts,
  count(*) FILTER (e.value <= p.top) AS reached FROM p LEFT JOIN e ON e.user_id = p.user_id
  AND e.event_date BETWEEN p.event_date - 14 AND p.event_date - 1 GROUP BY ALL),
 k AS (SELECT d.user_id, d.event_date, count(*) AS new_kinds FROM (SELECT DISTINCT user_id, event_date, event_type FROM e) d
  WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.user_id = d.user_id AND e.event_type = d.event_type
   AND e.event_date BETWEEN d.event_date - 14 AND d.event_date - 1) GROUP BY ALL),
 r AS (SELECT p.user_id, p.event_date, p.n, b.base_n, p.n_kinds, CASE WHEN b.base_n > 0 THEN coalesce(k.new_kinds, 0)::DOUBLE END AS new_kinds,
  CASE WHEN b.amounts > 0 AND p.top IS NOT NULL THEN (b.reached * 64 // b.amounts) / 64 END AS amount_rank
  FROM p JOIN b USING (user_id, event_date) LEFT JOIN k USING (user_id, event_date)),
 s AS (SELECT *, CASE WHEN base_n > 0 THEN 50 * new_kinds / n_kinds + 50 * coalesce(amount_rank, 0) END AS behaviour_score FROM r)"""

_EVEN = "count(*) FILTER (event_id % 2 = 0)"

SQL = {
    "index_after_clear": f"""SELECT date_trunc('second', ts) AS final_ts, {LOG_SOURCE} AS log_source, '10.0.0.' || user_id AS src_ip
FROM events WHERE event_type = 'signup' AND event_id % 3 = 2""",
    "table_after_truncate": f"""SELECT {LOG_SOURCE} AS log_source, event_type AS action, {_EVEN} AS n
FROM events GROUP BY event_type HAVING {_EVEN} > 0""",
    "loads_after_failure": """SELECT CASE event_type WHEN 'error' THEN 'error' ELSE 'login' END AS action, count(*) AS n
FROM events WHERE event_type IN ('signup', 'error') GROUP BY 1
UNION ALL SELECT 'FAIL', 0
UNION ALL SELECT 'SUCCESS', count(*) FROM events WHERE event_type IN ('signup', 'error')""",
    "stream_follows_names_and_rules": """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '10.0.0.' || user_id ELSE 'HR' END AS src_ip,
 CASE WHEN event_id % 2 = 0 THEN coalesce(s_name, 'Unknown_User') ELSE coalesce(upper(s_name), 'Unknown_User') END AS emp_name
FROM events LEFT JOIN supplier ON user_id = s_suppkey WHERE event_type = 'signup'""",
    "stream_stores_lines_once": """SELECT 'login' AS action, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n
FROM events WHERE event_type = 'signup' GROUP BY 2
UNION ALL SELECT 'error', NULL, sum(CASE WHEN event_id % 3 = 1 THEN 2 ELSE 1 END)::BIGINT FROM events WHERE event_type = 'error' HAVING count(*) > 0""",
    "behaviour_by_day": f"""WITH {_SCORES} SELECT user_id, CAST(event_date AS VARCHAR) AS event_date, n, base_n, n_kinds, new_kinds,
 round(amount_rank, 9) AS amount_rank, round(behaviour_score, 9) AS behaviour_score FROM s""",
    "alerts_by_behaviour": f"""WITH {_SCORES} SELECT event_id,
 round(CASE WHEN behaviour_score >= 75 THEN behaviour_score ELSE 10.0 END, 6) AS risk_score,
 CASE WHEN behaviour_score >= 75 THEN 'WARN: unusual for this user' ELSE 'Info: 정상 업무 활동' END AS alert_message
FROM e JOIN s USING (user_id, event_date)""",
}
