"""Tables and views of the session's catalog: whole, incremental, or by query."""

from pyspark.sql import DataFrame, SparkSession

from logweir.sources.database import after_last, bind_cursor, literal_kind
from logweir.sources.spec import SourceSpec


def read_catalog_table(
    spark: SparkSession, spec: SourceSpec, last: str | None = None, kind: str | None = None
) -> DataFrame:
    """As a database is read: the whole table, its rows after the cursor, or a bound query."""
    if spec.query:
        last = last or spec.first_cursor
        return spark.sql(bind_cursor(spec.query, last, literal_kind(kind, last)))
    if not spec.table_name:
        raise ValueError(f"[{spec.name}] needs a table_name or a query")
    return after_last(spark.table(spec.table_name), spec, last)
