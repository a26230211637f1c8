"""Cursors and incremental scans."""

import uuid

from pyspark.sql import functions as F

from logweir.operators.cursor import (
    after_cursor,
    after_cursor_text,
    batch_metrics,
)
from logweir.functions.times import clock
from logweir.plans.store import Store
from logweir.session import shared_folder
from logweir.sources.registry import Position, read_source
from logweir.sources.spec import SourceSpec
from logweir.workload.tables import LOG_SOURCE, table

_SINCE = "2024-01-15 12:00:00"


def cursor_filter(spark, folder):
    rows = after_cursor(table(spark, folder, "events"), "ts", _SINCE)
    return rows.select("event_id", "ts")


def cursor_filter_text(spark, folder):
    rows = after_cursor_text(table(spark, folder, "events"), "ts", _SINCE)
    return rows.select("event_id", "ts")


def cursor_metrics(spark, folder):
    return batch_metrics(after_cursor(table(spark, folder, "events"), "ts", _SINCE), "ts")


def cursor_state(spark, folder):
    """Each source's last time saved in a store; views start anew, clicks have a default."""
    store = Store(spark, f"{shared_folder(spark)}/runs/{uuid.uuid4().hex}")
    events = table(spark, folder, "events")
    last = events.groupBy(F.expr(LOG_SOURCE).alias("name")).agg(F.max(F.col("ts").cast("string")).alias("last"))
    found = []
    for row in last.collect():  # a row per source
        spec = SourceSpec(name=row["name"], watermark_default="0" if row["name"] == "Endpoint_Logs" else None)
        if row["name"] not in ("Endpoint_Logs", "Web_Logs"):
            store.save_cursor(spec, row["last"], "timestamp_ntz", 1, clock())
        found.append((spec.name, *store.position(spec)))
    return spark.createDataFrame(found, "source_name string, watermark_value string, watermark_type string")


def _view(spark, folder, name):
    """A given table as a view of the catalog."""
    view = f"{name}_{uuid.uuid4().hex}"
    table(spark, folder, name).createOrReplaceTempView(view)
    return view


def scan_after_id(spark, folder):
    """A table source whose cursor is an id: the comparison is textual and strict."""
    view = _view(spark, folder, "customer")
    spec = SourceSpec(name="hr", type="table", table_name=view, watermark_col="c_name")
    rows = read_source(spark, spec, Position("Customer#000000500", "string"))
    return rows.select("c_custkey", "c_name")


def scan_after_number(spark, folder):
    view = _view(spark, folder, "orders")
    spec = SourceSpec(name="o", type="table", table_name=view, watermark_col="o_orderkey")
    rows = read_source(spark, spec, Position("7000", "bigint"))
    return rows.select("o_orderkey", "o_custkey")


def scan_whole_table(spark, folder):
    """No watermark column: the cursor cuts nothing."""
    spec = SourceSpec(name="s", type="table", table_name=_view(spark, folder, "supplier"))
    return read_source(spark, spec, Position(spec.first_cursor))


_QUERY = (
    "SELECT o_orderkey, o_orderpriority FROM {} "
    "WHERE o_orderdate > :last_updated AND o_orderstatus = 'F'"
)


def scan_custom_query(spark, folder):
    """A configured query with the cursor bound as a literal of its saved type."""
    spec = SourceSpec(name="q", type="table", query=_QUERY.format(_view(spark, folder, "orders")))
    return read_source(spark, spec, Position("1997-06-01 00:00:00", "timestamp_ntz"))


QUERIES = {
    "cursor_filter": cursor_filter,
    "cursor_filter_text": cursor_filter_text,
    "cursor_metrics": cursor_metrics,
    "cursor_state": cursor_state,
    "scan_after_id": scan_after_id,
    "scan_after_number": scan_after_number,
    "scan_whole_table": scan_whole_table,
    "scan_custom_query": scan_custom_query,
}

SQL = {
    "cursor_filter": f"SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '{_SINCE}'",
    "cursor_filter_text": f"SELECT event_id, ts FROM events WHERE CAST(ts AS VARCHAR) > '{_SINCE}'",
    "cursor_metrics": f"""SELECT count(*) AS row_count, CAST(max(ts) AS VARCHAR) AS watermark_value
FROM events WHERE ts > TIMESTAMP '{_SINCE}'""",
    "cursor_state": f"""SELECT {LOG_SOURCE} AS source_name, CASE event_type WHEN 'click' THEN '0'
  WHEN 'view' THEN '1970-01-01 00:00:00' ELSE CAST(max(ts) AS VARCHAR) END AS watermark_value,
 CASE WHEN event_type NOT IN ('click', 'view') THEN 'timestamp_ntz' END AS watermark_type
FROM events GROUP BY event_type""",
    "scan_after_id": "SELECT c_custkey, c_name FROM customer WHERE c_name > 'Customer#000000500'",
    "scan_after_number": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 7000",
    "scan_whole_table": "SELECT * FROM supplier",
    "scan_custom_query": """SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderdate > TIMESTAMP '1997-06-01 00:00:00' AND o_orderstatus = 'F'""",
}
