"""Row fingerprint: the same event gets the same id in every batch."""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from logweir.constants import EPOCH_TEXT
from logweir.functions.text import literal, quoted
from logweir.schemas import PERSONAL_COLUMNS

# Left out: volatile columns, the display time (it repeats final_ts), personal data.
EXCLUDED = ["row_id", "created_at", "timestamp", "time_inferred", "parse_kind", *PERSONAL_COLUMNS]


def _text(field: T.StructField, zero_is_null: bool) -> str:
    """SQL text of a column as text; floating point with a fixed number of decimals."""
    name = quoted(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        value = f"nullif({name}, 0D)" if zero_is_null else name
        return (
            f"coalesce(CAST(try_cast({value} AS DECIMAL(38,6)) AS STRING), CAST({value} AS STRING))"
        )
    if isinstance(field.dataType, T.MapType):
        personal = ", ".join(literal(c) for c in PERSONAL_COLUMNS)
        return f"to_json(sort_array(map_entries(map_filter({name}, (k, v) -> NOT k IN ({personal})))))"
    if isinstance(field.dataType, (T.StructType, T.ArrayType)):
        return f"to_json({name})"
    return f"CAST({name} AS STRING)"


def fingerprint(df: DataFrame, columns: list[str] | None = None, zeros=()) -> Column:
    """md5 over the `|`-joined lower-case trimmed texts, columns in name order.

    A time that is only the ingest time counts as missing, so that re-reading the same
    line does not give a new id. So does a zero in the columns `zeros`, where it may
    stand for a missing value.
    """
    known = "NOT time_inferred" if "time_inferred" in df.columns else "true"
    fields = {f.name: f for f in df.schema}
    parts = []
    for name in sorted(columns or [c for c in df.columns if c not in EXCLUDED]):
        if name == "final_ts":
            seconds = "substring_index(CAST(try_cast(final_ts AS TIMESTAMP_NTZ) AS STRING), '.', 1)"
            parts.append(f"coalesce(IF({known}, {seconds}, NULL), {literal(EPOCH_TEXT)})")
        else:
            parts.append(f"lower(trim(coalesce({_text(fields[name], name in zeros)}, 'null')))")
    return F.expr(f"md5(concat_ws('|', {', '.join(parts)}))")


def with_row_id(df: DataFrame, columns: list[str] | None = None, zeros=()) -> DataFrame:
    return df.withColumn("row_id", fingerprint(df, columns, zeros))
