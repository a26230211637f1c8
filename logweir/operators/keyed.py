"""Keyed rows: latest per key, first per unique key, conforming and rejecting rows."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from logweir.constants import NUMERIC_SINK_COLUMNS, SINK_UTC_OFFSET, UNIQUE_KEY
from logweir.functions.times import now_local, sink_time


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in `order`.

    Spark limits each key to one row per task before the shuffle, so a key with very
    many copies sends at most one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def document_id(columns: list[str]) -> Column:
    """Key of a document: the id columns as text, joined by `_`; null counts as empty."""
    return F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Target and batch as one table in which the highest version of a key stands."""
    both = target.unionByName(batch, allowMissingColumns=True)
    return latest_per_key(both, keys, [F.col(version).desc()])


def insert_unique(
    batch: DataFrame,
    order: list[Column],
    target: DataFrame | None = None,
    keys: list[str] = UNIQUE_KEY,
) -> DataFrame:
    """Rows of the batch that a unique key lets in: the first of each key not yet stored.

    A null in any key part never collides, so those rows pass without a shuffle.
    """
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    first = latest_per_key(batch.filter(whole), keys, order)
    if target is not None:
        first = first.join(target.select(*keys), keys, "left_anti").select(*batch.columns)
    return first.unionByName(batch.filter(~whole))


def conform(df: DataFrame, schema, created_at: Column | None = None) -> DataFrame:
    """The columns of `schema`, cast where possible, null where missing or malformed."""
    columns = []
    for field in schema:
        if field.name == "created_at":
            value = created_at if created_at is not None else now_local()
            value = value.cast(field.dataType)
        elif field.name in df.columns:
            value = F.col(field.name).try_cast(field.dataType)
        else:
            value = F.lit(None).cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def coerce_numbers(df: DataFrame, columns=NUMERIC_SINK_COLUMNS) -> DataFrame:
    """Doubles in the numeric columns present; malformed text becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns if c in df.columns})


def zero_nulls(df: DataFrame, columns=NUMERIC_SINK_COLUMNS) -> DataFrame:
    return df.fillna(0.0, [c for c in columns if c in df.columns])


def alert_document(df: DataFrame, offset: str = SINK_UTC_OFFSET) -> DataFrame:
    """Document form: ISO time with offset, numbers as doubles without nulls."""
    df = zero_nulls(coerce_numbers(df))
    return df.withColumn("final_ts", sink_time("final_ts", offset))


def load_error(df: DataFrame, casts: dict[str, str]) -> Column:
    """Why a row cannot be loaded: the first column (in name order) with a bad value."""
    reasons = [
        F.when(
            F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull(),
            F.concat(F.lit(f"{c}: not a {kind}: "), F.col(c).cast("string")),
        )
        for c, kind in sorted(casts.items())
        if c in df.columns
    ]
    return F.coalesce(*reasons) if reasons else F.lit(None).cast("string")


def with_load_error(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    return df.withColumn("error_reason", load_error(df, casts))


def load_counts(df: DataFrame) -> DataFrame:
    """Loaded and failed rows of a batch that carries `error_reason`."""
    bad = F.col("error_reason").isNotNull()
    return df.agg(F.count_if(~bad).alias("loaded"), F.count_if(bad).alias("failed"))
