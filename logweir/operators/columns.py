"""Column-wise clean-up and the standard event shape."""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from logweir.constants import DEFAULTS, FILE_NAME_SOURCES, REQUIRED_COLUMNS, UNKNOWN_SOURCE
from logweir.functions.text import literal, quoted
from logweir.functions.times import now_local, seconds_sql


def non_null_counts(df: DataFrame) -> DataFrame:
    """One row, one count of non-null values per column."""
    return df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])


def drop_all_null_columns(df: DataFrame, keep=()) -> DataFrame:
    """Batch only: the columns that hold a value somewhere. Runs one aggregate."""
    counts = non_null_counts(df).first()
    return df.select(*[c for c in df.columns if counts[c] or c in keep])


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null in float and double columns."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def complete_required(df: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    return df.withColumns({c: F.expr("CAST(NULL AS STRING)") for c in missing})


def fill_defaults(df: DataFrame, defaults=DEFAULTS) -> DataFrame:
    filled = "coalesce(CAST({} AS STRING), {})"
    return df.withColumns(
        {c: F.expr(filled.format(quoted(c), literal(v))) for c, v in defaults.items()}
    )


def event_time_of(df: DataFrame, name: str) -> str:
    """SQL text of a text or time column as event time, null where it is no time."""
    if isinstance(df.schema[name].dataType, (T.TimestampNTZType, T.TimestampType)):
        return f"CAST({quoted(name)} AS TIMESTAMP_NTZ)"
    return f"try_cast(CAST({quoted(name)} AS STRING) AS TIMESTAMP_NTZ)"


def event_times(df: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """`final_ts` from final_ts, then timestamp, then the ingest time; `timestamp` for display.

    `time_inferred` marks rows whose time is only the ingest time.
    """
    known = [event_time_of(df, c) for c in ("final_ts", "timestamp") if c in df.columns]
    known = f"coalesce({', '.join(known)})" if known else "CAST(NULL AS TIMESTAMP_NTZ)"
    now = ingest_time if ingest_time is not None else now_local()
    df = df.withColumn("_known", F.expr(known)).withColumns(
        {
            "final_ts": F.coalesce("_known", now.cast("timestamp_ntz")),
            "time_inferred": F.expr("_known IS NULL"),
        }
    )
    return df.drop("_known").withColumn("timestamp", F.expr(seconds_sql("final_ts")))


def standard_event(
    df: DataFrame, source: str | Column, ingest_time: Column | None = None
) -> DataFrame:
    """Required columns, defaults, source tag and event time on mapped rows."""
    tag = F.lit(source) if isinstance(source, str) else source
    df = fill_defaults(complete_required(df)).withColumn("log_source", tag)
    return event_times(df, ingest_time)


def classify_name(name, parts=FILE_NAME_SOURCES, otherwise=UNKNOWN_SOURCE) -> Column:
    """Source of a file name: the first listed part it contains."""
    name = F.col(name) if isinstance(name, str) else name
    chain = F
    for part, source in parts:
        chain = chain.when(name.contains(part), F.lit(source))
    return chain.otherwise(F.lit(otherwise))
