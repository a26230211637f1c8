"""Database tables over JDBC: whole, incremental, or by query."""

import re
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from logweir.constants import EPOCH_TEXT
from logweir.operators.cursor import after_cursor
from logweir.sources.spec import SourceSpec

# Source type -> JDBC scheme and driver class.
DIALECTS = {
    "postgres": ("postgresql", "org.postgresql.Driver"),
    "postgresql": ("postgresql", "org.postgresql.Driver"),
    "mysql": ("mysql", "com.mysql.cj.jdbc.Driver"),
    "mariadb": ("mysql", "com.mysql.cj.jdbc.Driver"),
}
DEFAULT_PARTITIONS = 32
PLACEHOLDER = ":last_updated"
_NUMBER = re.compile(r"-?\d+(\.\d+)?")


def bind_cursor(query: str, last: str, kind: str = "string") -> str:
    """The query with its placeholder, if any, as a typed literal."""
    if kind == "number":
        if not _NUMBER.fullmatch(last):
            raise ValueError(f"not a number: {last!r}")
        literal = last
    else:
        quoted = last.replace("'", "''")
        literal = f"TIMESTAMP '{quoted}'" if kind == "timestamp" else f"'{quoted}'"
    return query.replace(PLACEHOLDER, literal)


def literal_kind(kind: str | None, last: str | None = None) -> str:
    """How a cursor of a saved type is written: number, timestamp or string.

    Without a saved type a number is told by its form; anything else is text, which
    databases compare with their own types.
    """
    if kind is None:
        return "number" if last is not None and _NUMBER.fullmatch(last) else "string"
    if kind.startswith(("timestamp", "date")):
        return "timestamp"
    numbers = ("tinyint", "smallint", "int", "bigint", "decimal", "double", "float")
    return "number" if kind.startswith(numbers) else "string"


def _table(spec: SourceSpec, last: str | None, kind: str | None) -> str:
    """What is read, as a table expression."""
    if not spec.query:
        return spec.table_name
    last = last or spec.first_cursor
    return f"({bind_cursor(spec.query, last, literal_kind(kind, last))}) q"


def jdbc_options(spec: SourceSpec, last: str | None = None, kind: str | None = None) -> dict:
    """Reader options: address by dialect, table or query, and how to split the read."""
    if spec.kind not in DIALECTS:
        raise ValueError(f"[{spec.name}] unsupported database type: {spec.type}")
    if not spec.database:
        raise ValueError(f"[{spec.name}] no database name")
    if not spec.query and not spec.table_name:
        raise ValueError(f"[{spec.name}] needs a table_name or a query")
    scheme, driver = DIALECTS[spec.kind]
    options = {
        "url": f"jdbc:{scheme}://{spec.host}:{spec.port}/{spec.database}",
        "driver": driver,
        "fetchsize": "10000",
        "dbtable": _table(spec, last, kind),
    }
    user, password = spec.credentials()
    if user:
        options["user"] = user
    if password:
        options["password"] = password
    column = split_column(spec)
    if column and spec.partition_lower is not None:
        options["partitionColumn"] = column
        options["lowerBound"] = str(spec.partition_lower)
        options["upperBound"] = str(spec.partition_upper)
        options["numPartitions"] = str(spec.partition_count or DEFAULT_PARTITIONS)
    return options


def split_column(spec: SourceSpec) -> str | None:
    """The column a read is split by: the configured one, else the watermark column."""
    return spec.partition_col or spec.watermark_col


def bounds_options(spec: SourceSpec, last: str | None = None, kind: str | None = None) -> dict:
    """Options that read the least and greatest value of the split column after the cursor.

    The rows that will be read are those after the cursor: splits placed over the whole table
    would leave all of them in the last one where the split column grows with the cursor.
    """
    column = split_column(spec)
    options = jdbc_options(spec, last, kind)
    query = f"SELECT min({column}) AS low, max({column}) AS high FROM {options.pop('dbtable')}"
    begun = last is not None and (kind, last) != (None, EPOCH_TEXT)
    if not spec.query and spec.watermark_col and begun:
        bound = bind_cursor(PLACEHOLDER, last, literal_kind(kind, last))
        query += f" WHERE {spec.watermark_col} > {bound}"
    return {**options, "query": query}


_SPLITS = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def with_bounds(
    spark: SparkSession, spec: SourceSpec, last: str | None = None, kind: str | None = None
) -> SourceSpec:
    """The spec with the bounds of its split column, asked from the database if not given.

    They only place the splits; rows outside are read all the same. A watermark column that
    is neither number nor time splits nothing, nor does a table without a new row.
    """
    if not split_column(spec) or spec.partition_lower is not None:
        return spec
    bounds = spark.read.format("jdbc").options(**bounds_options(spec, last, kind)).load()
    if not isinstance(bounds.schema[0].dataType, _SPLITS):
        return spec
    row = bounds.first()
    if row[0] is None:
        return spec
    return replace(spec, partition_lower=str(row[0]), partition_upper=str(row[1]))


def after_last(df: DataFrame, spec: SourceSpec, last: str | None = None) -> DataFrame:
    """A table read with a watermark column is cut at the cursor; Spark pushes it down."""
    if spec.query or not spec.watermark_col or last is None:
        return df
    return after_cursor(df, spec.watermark_col, last)


def read_table(
    spark: SparkSession, spec: SourceSpec, last: str | None = None, kind: str | None = None
) -> DataFrame:
    """A table or query; every split of its split column is its own task.

    `kind` is the saved type of the cursor `last`.
    """
    spec = with_bounds(spark, spec, last, kind)
    rows = spark.read.format("jdbc").options(**jdbc_options(spec, last, kind)).load()
    return after_last(rows, spec, last)
