"""A global row number without sending all rows to one task."""

from pyspark.sql import DataFrame, Window, functions as F

from logweir.session import shared_folder

_IN_PARTITION = (1 << 33) - 1


def with_ordinal(df: DataFrame, order: list[str], out: str = "ordinal") -> DataFrame:
    """0-based position in the order of `order`.

    Rows are range-partitioned and sorted, fixed by a checkpoint, and numbered inside
    their partition; a partition starts where the sizes of those before it add up to.
    Only these sizes, one row per partition, meet in a window. The row hash and the
    random number spread rows with equal keys over partitions.
    """
    spark = df.sparkSession
    shared_folder(spark)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    keys = [F.col(c) for c in order]
    spread = df.withColumn("_tie", F.rand(7))
    ranged = (
        spread.repartitionByRange(parts, *keys, "_tie")
        .sortWithinPartitions(*keys, "_tie")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION)))
        .drop("_tie")
        .checkpoint()
    )
    before = Window.orderBy("_start_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(F.col("_part").alias("_start_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            "_start_part",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        )
    )
    # one row per partition: bounded by the setting above, whatever the data
    joined = ranged.join(F.broadcast(starts), F.col("_part") == F.col("_start_part"))
    return joined.withColumn(out, F.col("_start") + F.col("_at")).drop(
        "_part", "_at", "_start_part", "_start"
    )


def assign_assets(employees: DataFrame) -> DataFrame:
    """An address and a device per employee, derived from the position by id."""
    placed = with_ordinal(employees, ["emp_id"])
    at = F.col("ordinal")
    address = F.concat(
        F.lit("192.168."), (at % 20 + 10).cast("string"), F.lit("."), (at % 250 + 1).cast("string")
    )
    return placed.select(
        F.col("emp_id").alias("user_id"),
        F.col("user_name").alias("user"),
        F.col("dept_name").alias("dept"),
        address.alias("ip"),
        F.concat(F.lit("WS-"), F.col("emp_id").cast("string")).alias("device_id"),
    )
