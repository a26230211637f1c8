"""High-watermark cursors: filter and advance."""

from datetime import datetime
from decimal import Decimal, InvalidOperation

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from logweir.constants import EPOCH_TEXT


def after_cursor(df: DataFrame, column: str, last: str) -> DataFrame:
    """Rows strictly after the cursor, compared in the column's own type.

    A typed comparison with a literal can be pushed into the scan or the database. A cursor
    that is no value of a numeric or time type is an error: reading on from nowhere would read
    the whole table again.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return df.filter(F.col(column) > F.lit(last))
    if last == EPOCH_TEXT and isinstance(kind, T.NumericType):
        return df  # nothing has been read yet
    return df.filter(F.col(column) > F.lit(_typed(last, kind)).cast(kind))


def _typed(last: str, kind: T.DataType):
    """The cursor as a value that the type can hold."""
    try:
        if isinstance(kind, T.IntegralType):
            return int(last)
        if isinstance(kind, T.DecimalType):
            return Decimal(last)
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return float(last)
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return str(datetime.fromisoformat(last.strip()))
    except (ValueError, InvalidOperation) as bad:
        raise ValueError(f"the cursor {last!r} is no {kind.simpleString()}") from bad
    return last


def after_cursor_text(df: DataFrame, column: str, last: str) -> DataFrame:
    """Rows strictly after the cursor, compared as text."""
    return df.filter(F.col(column).cast("string") > F.lit(last))


def batch_metrics(df: DataFrame, column: str = "final_ts") -> DataFrame:
    """Row count and new cursor of a batch in one pass; nulls are ignored."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.max(column).cast("string").alias("watermark_value"),
    )
