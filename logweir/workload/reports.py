"""Run history as the monitor shows it."""

from pyspark.sql import functions as F

from logweir.operators.totals import latest_runs, run_report
from logweir.workload.tables import table


def _history(spark, folder):
    """Orders in the role of runs."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderdate").alias("collect_time"),
        F.col("o_orderpriority").alias("source_name"),
        F.lit("alerts").alias("target_index"),
        (F.col("o_custkey") * 1000).alias("processed_count"),
        F.when(F.col("o_orderstatus") == "F", "FAIL").otherwise("SUCCESS").alias("status"),
    )


def history_latest(spark, folder):
    return latest_runs(_history(spark, folder))


def history_report(spark, folder):
    return run_report(_history(spark, folder))


QUERIES = {"history_latest": history_latest, "history_report": history_report}

_HISTORY = """h AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderdate AS collect_time,
 o_orderpriority AS source_name, 'alerts' AS target_index, o_custkey * 1000 AS processed_count,
 CASE WHEN o_orderstatus = 'F' THEN 'FAIL' ELSE 'SUCCESS' END AS status FROM orders
 ORDER BY collect_time DESC, id DESC LIMIT 30)"""

SQL = {
    "history_latest": f"WITH {_HISTORY} SELECT * FROM h",
    "history_report": f"""WITH {_HISTORY} SELECT id, collect_time, source_name, target_index,
 format('{{:,}}', processed_count) || ' 건' AS processed,
 CASE WHEN status = 'SUCCESS' THEN '✅ 성공' ELSE '❌ 실패' END AS status_label FROM h""",
}
