"""A key, date or group with a third of all rows does not end in one task."""

import contextlib
import glob

from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.operators.enrich import add_person_name
from logweir.operators.keyed import insert_unique
from logweir.operators.ordinal import with_ordinal
from logweir.operators.parse import parse_columns
from logweir.plans.events import prepared_lookup
from logweir.sinks.loads import LoadTable


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SMALL = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64k",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "64k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1",
}


def hot(column, every=3):
    return F.when(F.col(column) % every == 0, F.lit(7)).otherwise(F.col(column))


def test_hot_user_is_split_where_the_lookup_is_too_large(spark, tmp_path):
    with settings(spark, **SMALL):
        people = spark.range(20000).select(
            F.col("id").cast("string").alias("emp_id"), F.concat(F.lit("n"), "id").alias("emp_name")
        )
        lookup = prepared_lookup(people, f"{tmp_path}/people")
        text = F.sha2(F.col("id").cast("string"), 256).alias("text")
        events = spark.range(0, 60000, 1, 16).select(text, hot("id").alias("user_id"))
        named = add_person_name(events, lookup).agg(
            F.count_if(F.col("emp_name") == "n7").alias("hot"),
            F.count_if(F.col("emp_name") == "Unknown_User").alias("missed"),
            F.count_distinct("text").alias("n"),
        )
        row = named.collect()[0]
        plan = named._jdf.queryExecution().executedPlan().toString()
    assert (row["hot"], row["n"]) == (20001, 60000)
    assert row["missed"] == sum(1 for i in range(20000, 60000) if i % 3)
    assert "skew=true" in plan


def test_hot_date_is_written_as_several_files(spark, tmp_path):
    shape = T.StructType().add("id", "long").add("text", "string").add("day", "string")
    table = LoadTable(spark, str(tmp_path), shape, ["day"])
    rows = spark.range(0, 90000, 1, 16).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 20).cast("string")).alias("day"),
    )
    with settings(spark, **SMALL):
        table.put(rows, "s", 1)
    files = {d: len(glob.glob(f"{table.folder('s', 1)}/day={d}/*.parquet")) for d in ("hot", "1")}
    assert files["hot"] > 2 * files["1"]
    assert table.load("s", 1).count() == 90000


def test_copies_of_one_row_leave_each_task_once(spark):
    """Half of the rows are copies under one key; the shuffle gets one per task."""
    rows = spark.range(0, 40000, 1, 8).select(
        "id", F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id")).alias("k")
    )
    first = insert_unique(rows, [F.col("id")], keys=["k"])
    got = first.agg(F.count(F.lit(1)), F.min("id"), F.sum(F.col("id"))).first()
    assert tuple(got) == (20000, 0, sum(range(3, 40000, 2)))


def test_equal_keys_spread_over_the_ordinal_partitions(spark):
    rows = spark.range(0, 30000, 1, 8).select(hot("id", 2).alias("k"))
    placed = with_ordinal(rows, ["k"])
    got = placed.agg(F.count_distinct("ordinal"), F.min("ordinal"), F.max("ordinal")).first()
    assert tuple(got) == (30000, 0, 29999)
    below = placed.filter("k = 7").agg(F.min("ordinal"), F.max("ordinal")).first()
    assert tuple(below) == (3, 3 + 15000)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" in plan and plan.count("Exchange SinglePartition") == 1
    sizes = placed.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 15000


def test_filters_do_not_parse_again(spark):
    lines = spark.createDataFrame([('{"a":1}',)], "value string")
    parsed = parse_columns(lines, ["a", "final_ts"]).filter("parse_kind = 'json' AND a > '0'")
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(ArrayType") == 1
