"""The alert index: loads of documents keyed by row id, and tables made from it."""

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from logweir.constants import (
    BLANK,
    EPOCH_TEXT,
    ERROR_SAMPLE,
    LATE,
    NUMERIC_SINK_COLUMNS,
    SINK_UTC_OFFSET,
    UNIQUE_KEY,
)
from logweir.functions.fingerprint import EXCLUDED, with_row_id
from logweir.functions.text import literal, quoted
from logweir.functions.times import sink_time
from logweir.operators.keyed import conform, insert_unique
from logweir.schemas import ALERT_DOC, PERSONAL_COLUMNS, alert_table
from logweir.sinks.loads import LoadTable

PARTITIONS = ["load_status", "event_date"]
TABLE_PARTS = ["alert_date", "alert_load"]
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
ID_KEYS = ["log_source", "event_date", "row_id"]
# stored columns that a source may send without declaring them
_SCORES = ["risk_score", "alert_message"]
_FROM_EXTRAS = [*[c for c in NUMERIC_SINK_COLUMNS if c not in _SCORES], "emp_name"]


def as_documents(events: DataFrame, personal: bool = False) -> DataFrame:
    """Scored events in the stored form: fixed columns, all others as text in `extras`.

    Numbers are doubles; one that is missing or malformed in a field the source has is 0.
    The row id is taken from this form and reads a zero as a missing number, so it does
    not depend on which keys a source declares as columns. Personal fields are stored only
    when asked for, and never part of the id.
    """
    fixed = [f for f in ALERT_DOC if f.name not in ("row_id", "extras", *PARTITIONS)]
    outside = {"log_source", "load_seq", "parse_kind", "extras", "row_id", "place"}
    if not personal:
        outside.update(PERSONAL_COLUMNS)
    present = [c for c in events.columns if c not in outside]
    spare = [c for c in present if c not in {f.name for f in fixed}]
    open_form = "extras" in events.columns
    given = "coalesce(extras, map())" if open_form else "CAST(map() AS MAP<STRING, STRING>)"
    taken = [n for n in _FROM_EXTRAS if open_form and n not in present]

    columns = []
    for field in fixed:
        name, kind = field.name, field.dataType.simpleString()
        value = f"CAST(NULL AS {kind})"
        if name in present:
            value = f"try_cast({quoted(name)} AS {kind})"
            if name in NUMERIC_SINK_COLUMNS:
                value = f"coalesce({value}, 0D)"
        elif name in taken:
            value = f"try_cast(extras[{literal(name)}] AS {kind})"
            if name in NUMERIC_SINK_COLUMNS:
                value = f"IF(map_contains_key(extras, {literal(name)}), coalesce({value}, 0D), NULL)"
        columns.append(f"{value} AS {quoted(name)}")
    withheld = [] if personal else PERSONAL_COLUMNS
    hidden = ", ".join(literal(n) for n in [*spare, *taken, *_SCORES, *withheld])
    kept = f"map_filter({given}, (k, v) -> v IS NOT NULL AND NOT k IN ({hidden}))"
    if spare:
        pairs = ", ".join(f"{literal(c)}, CAST({quoted(c)} AS STRING)" for c in spare)
        kept = f"map_concat({kept}, map_filter(map({pairs}), (k, v) -> v IS NOT NULL))"
    place = "place" if "place" in events.columns else "CAST(NULL AS STRING) AS place"
    rows = events.selectExpr("log_source", *columns, f"{kept} AS extras", place)
    hashed = [c for c in rows.columns if c not in (*EXCLUDED, "place")]
    rows = with_row_id(rows, hashed, zeros=NUMERIC_SINK_COLUMNS)
    # equal lines without a time are different events: their places tell them apart
    placed = F.md5(F.concat_ws("|", "row_id", "place"))
    own = F.when(F.col("time_inferred") & F.col("place").isNotNull(), placed).otherwise(F.col("row_id"))
    return rows.withColumn("row_id", own).drop("place")


def with_partitions(documents: DataFrame) -> DataFrame:
    """Partition columns. A row without a time of its own has the date of its ingest.

    Late rows and blank lines are only counted: nothing else of them is stored.
    """
    reason = F.col("error_reason")
    counted = reason.isin(LATE, BLANK)
    status = F.when(reason.isNull(), "loaded").when(counted, reason).otherwise("rejected")
    epoch = F.lit(EPOCH_TEXT[:10]).cast("date")
    day = F.when(F.coalesce(counted, F.lit(False)), epoch).otherwise(F.col("final_ts").cast("date"))
    parted = documents.withColumns({"load_status": status, "event_date": day})
    kept = F.coalesce(~counted, F.lit(True))
    emptied = {
        c: F.when(kept, F.col(c)) for c in documents.columns if c not in ("log_source", "load_seq", *PARTITIONS)
    }
    return parted.withColumns(emptied)


def document_value(name: str):
    """A field of a stored document, from its column or from `extras`."""
    return F.col(name) if name in ALERT_DOC.fieldNames() else F.col("extras")[name]


def _load_metrics(last, cursor_col: str, cursor_type: str) -> list[Column]:
    """Rows of each status, and the cursor after them.

    A time that is only the ingest time never moves the cursor, and late rows do not move it back.
    """
    value = document_value(cursor_col).try_cast(cursor_type)
    if cursor_col == "final_ts":
        value = F.when(~F.col("time_inferred"), value)
    counts = [F.count_if(F.col("load_status") == s).alias(s) for s in ("loaded", "rejected", LATE, BLANK)]
    newest = F.greatest(F.max(value), F.lit(last).try_cast(cursor_type))
    return [*counts, newest.cast("string").alias("cursor")]


class AlertIndex(LoadTable):
    """Accepted and rejected rows of a load go out in one pass, apart by partition."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, ALERT_DOC, PARTITIONS)

    def put(self, rows: DataFrame, source: str, seq: int, last=None, cursor_col="final_ts", cursor_type="timestamp_ntz") -> dict:
        """Write a load; its counts (loaded, rejected, late, blank) and cursor, taken as it is written.

        Columns of a document that the rows lack are null, as a reader of the load finds them.
        """
        absent = {f.name: F.lit(None).cast(f.dataType) for f in ALERT_DOC if f.name not in (*rows.columns, "log_source", *PARTITIONS)}
        rows = rows.withColumns(absent)
        return super().put(with_partitions(rows), source, seq, _load_metrics(last, cursor_col, cursor_type))

    def summary(
        self, source: str, seq: int, last=None, cursor_col="final_ts", cursor_type="timestamp_ntz"
    ):
        """What `put` has returned of a load, counted again from its files."""
        return self.load(source, seq).agg(*_load_metrics(last, cursor_col, cursor_type)).first()

    def alerts(self) -> DataFrame:
        """The index: one document per row id, the newest load's.

        Source and date follow from what the id covers, so they may join the key, and a
        filter on them reaches the scans of the base and of the open loads.
        """
        latest = self.latest([*ID_KEYS, "load_status"], F.col("load_status") == "loaded")
        return latest.drop("load_status", "error_reason")

    def merge(self, keep: int = 1) -> None:
        """Closed loads into the base: a document per row id, rejects with them."""
        super().merge([*ID_KEYS, "load_status"], keep, F.col("load_status").isin("loaded", "rejected"))

    def documents(self, offset: str = SINK_UTC_OFFSET) -> DataFrame:
        """The index with times as ISO text in the configured offset."""
        return self.alerts().withColumn("final_ts", sink_time("final_ts", offset))

    def rejects(self) -> DataFrame:
        """Rows that could not be loaded, with the reason."""
        return self.latest([*ID_KEYS, "load_status"], F.col("load_status") == "rejected")

    def first_errors(self, source: str, seq: int, limit: int = ERROR_SAMPLE) -> DataFrame:
        """A few reasons of one load, for the log, by row id; rows without one come last."""
        bad = self.load(source, seq).filter(F.col("load_status") == "rejected")
        return bad.select("error_reason", "row_id").orderBy(F.asc_nulls_last("row_id"), "error_reason").limit(limit)


def create_alert_table(
    spark: SparkSession, name: str, personal: bool = False, path: str | None = None
) -> None:
    """Drop and create the relational alert table, parted by day and load; only on request."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    parts = T.StructType([T.StructField(TABLE_PARTS[0], T.DateType()), T.StructField(TABLE_PARTS[1], T.LongType())])
    shape = T.StructType([*alert_table(personal).fields, *parts.fields])
    writer = spark.createDataFrame([], shape).write.format("parquet").partitionBy(*TABLE_PARTS)
    if path:
        writer = writer.option("path", path).mode("overwrite")
    writer.saveAsTable(name)


def truncate_table(spark: SparkSession, name: str) -> None:
    """Empty a table, one at a path of its own too, which TRUNCATE TABLE does not take."""
    with _overwriting(spark, "static"):
        spark.createDataFrame([], spark.table(name).schema).write.insertInto(name, overwrite=True)


def reset_index(spark: SparkSession, path: str, schema) -> None:
    """Replace an index by an empty one of the given schema; only ever on request."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def insert_alerts(
    spark: SparkSession,
    name: str,
    batch: DataFrame,
    staging: str,
    seq: int,
    keys: list[str] = UNIQUE_KEY,
) -> None:
    """Insert the rows of batch `seq` whose unique key no other batch has put in the table.

    The batch is evaluated once, into a load under `staging`; bounds, keys and rows are read
    from there. Of equal keys in it the first wins, as the rows came. The table is parted by
    day and load number, and a batch replaces its own parts: a retry neither doubles rows
    with a null key part nor takes its own earlier rows for another's.
    """
    target = spark.table(name)
    table = LoadTable(spark, staging, _staged(target.schema))
    day = F.coalesce(F.col("final_ts").cast("date"), F.lit(EPOCH_TEXT[:10]).cast("date"))
    rows = conform(batch, target.schema).withColumns(
        {TABLE_PARTS[0]: day, TABLE_PARTS[1]: F.lit(seq).cast("bigint"), "arrival": F.monotonically_increasing_id()}
    )
    table.put(rows.withColumnRenamed("log_source", "table_source"), name, seq)
    rows = table.load(name, seq).drop("log_source", "load_seq").withColumnRenamed("table_source", "log_source")
    others = target.filter(F.col(TABLE_PARTS[1]) != seq)
    new = insert_unique(rows, [F.col("arrival")], _same_times(others, rows, keys), keys)
    with _overwriting(spark, "dynamic"):
        new.select(*target.columns).write.insertInto(name, overwrite=True)


@contextmanager
def _overwriting(spark: SparkSession, mode: str):
    """Which parts of a table an overwrite replaces: all, or those it writes."""
    before = spark.conf.get(_OVERWRITE)
    spark.conf.set(_OVERWRITE, mode)
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE, before)


def _staged(schema: T.StructType) -> T.StructType:
    """The table's columns as a load keeps them, with the order of arrival."""
    names = {"log_source": "table_source"}
    fields = [T.StructField(names.get(f.name, f.name), f.dataType) for f in schema]
    return T.StructType([*fields, T.StructField("arrival", T.LongType())])


def _same_times(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The part of the table whose times the batch spans: no other row can hold its keys.

    The bounds are literals, so the scan skips what lies outside.
    """
    if "final_ts" not in keys:
        return target
    low, high = rows.agg(F.min("final_ts"), F.max("final_ts")).first()
    low, high = (F.lit(None if x is None else str(x)).cast("timestamp_ntz") for x in (low, high))
    days = F.col(TABLE_PARTS[0]).between(low.cast("date"), high.cast("date"))
    return target.filter(days & F.col("final_ts").between(low, high))


def merge_by_id(batch: DataFrame, table: str, key: str = "row_id") -> None:
    """Upsert into a table whose format supports MERGE."""
    (
        batch.alias("batch")
        .mergeInto(table, F.expr(f"{table}.{key} = batch.{key}"))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def write_json_lines(df: DataFrame, path: str) -> None:
    """Append rows as raw JSON lines, one object per line, text unescaped."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(path)
