"""Tables written one load at a time.

A load of one source has its own folder, which a repeated load replaces. A retry after
any failure therefore ends in the same files, and no load rewrites another's rows.
Readers take the newest version of a key. Merging puts closed loads into a base beside the
table, by the partitions they touch, so that a read ranks the open loads only.
"""

import time

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql import types as T

from logweir.operators.keyed import latest_per_key
from logweir.sinks.slots import SlotTable

_MERGED = T.StructType([T.StructField("log_source", T.StringType()), T.StructField("upto", T.LongType())])

# Characters that stand escaped in the name of a partition folder.
_ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(i) for i in range(32)}


def folder_name(value: str) -> str:
    """A value as Spark writes it into a partition folder's name."""
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)


def _bounds(rows: DataFrame) -> dict[str, int]:
    return {r["log_source"]: r["upto"] for r in rows.collect()}  # a row per source


def _after(rows: DataFrame, upto: dict[str, int]) -> DataFrame:
    """Rows of loads behind each source's bound, by literals, so that a scan leaves out the other folders."""
    for source, seq in upto.items():
        rows = rows.filter((F.col("log_source") != source) | (F.col("load_seq") > seq))
    return rows


class LoadTable:
    """Parquet under `log_source=<s>/load_seq=<n>/`; one writer per source."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partitions=()):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partitions = list(partitions)
        self.schema = schema
        # up to which load of a source the base holds
        self.merged = SlotTable(spark, f"{self.path}-merged", _MERGED, ["log_source"])
        # up to which load of a source readers see nothing any more
        self.cleared = SlotTable(spark, f"{self.path}-cleared", _MERGED, ["log_source"])

    def folder(self, source: str, seq: int) -> str:
        return f"{self.path}/log_source={folder_name(source)}/load_seq={seq}"

    def put(self, rows: DataFrame, source: str, seq: int, metrics: list[Column] | None = None) -> dict:
        """Write, or on a repeat replace, one load; returns the aggregates `metrics` of what was written.

        The rebalance hint lets AQE size the files: it splits a partition value that
        holds most rows and merges the small ones. The metrics are observed behind it, in the
        tasks that write, of which Spark counts each one's first success only: neither a task
        that is tried again nor a stage before it that is run again counts twice.
        """
        rows = rows.drop("log_source", "load_seq")
        rows = rows.hint("rebalance", *self.partitions) if self.partitions else rows
        observed = Observation() if metrics else None
        rows = rows.observe(observed, *metrics) if observed else rows
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if self.partitions:
            writer = writer.partitionBy(*self.partitions)
        writer.parquet(self.folder(source, seq))
        return observed.get if observed else {}

    def load(self, source: str, seq: int) -> DataFrame:
        """The rows of one load, without listing any other."""
        return self._read(self.folder(source, seq))

    def rows(self) -> DataFrame:
        """All rows of all loads that are still there, with `log_source` and `load_seq`."""
        return self._read(self.path)

    def open_rows(self) -> DataFrame:
        """The rows of loads that the base does not hold yet."""
        return _after(self.rows(), self._closed())

    def _closed(self) -> dict[str, int]:
        """Per source the last load that readers do not look for: merged or cleared."""
        both = self.merged.read().unionByName(self.cleared.read())
        return _bounds(both.groupBy("log_source").agg(F.max("upto").alias("upto")))

    def base_rows(self) -> DataFrame:
        """What merging has left: one row per key, its load in `base_seq`."""
        return _after(self._read(f"{self.path}-base", base=True), _bounds(self.cleared.read()))

    def clear(self) -> None:
        """Empty the table for its readers, as one commit; only ever on request.

        Each source's loads up to its newest are bounded off: no file is touched, so a reader that
        has planned goes on, a load that has not begun to write stands, and the repeat of an old
        load stays out. `drop_merged` removes the files.
        """
        loads = self.rows().select("log_source", "load_seq").union(self.merged.read().select("log_source", "upto"))
        upto = loads.groupBy("log_source").agg(F.max("load_seq").alias("upto"))
        self.cleared.upsert(upto, time.time_ns())

    def latest(self, keys: list[str], where=None) -> DataFrame:
        """The newest load's row of each key.

        Only the open loads are ranked; of the base those rows go whose key an open load has,
        so the base is not shuffled where the open keys are few. `where` should name partition
        columns: it is applied to both sides, before anything else.
        """
        open_rows, base = self.open_rows(), self.base_rows()
        if where is not None:
            open_rows, base = open_rows.filter(where), base.filter(where)
        newest = latest_per_key(open_rows, keys, [F.col("load_seq").desc()])
        return base.join(newest.select(*keys), keys, "left_anti").unionByName(newest)

    def merge(self, keys: list[str], keep: int = 1, where=None) -> None:
        """Merge the open loads, but the newest `keep` of each source, into the base.

        Only the partitions that these loads touch are written again. A newest load may still
        be repeated, so it stays apart. Merging again after a failure gives the same rows, and
        until the new bound is saved readers see the loads as open, which hides the old base.
        """
        loads = self.open_rows().select("log_source", "load_seq").distinct()
        nth = F.row_number().over(Window.partitionBy("log_source").orderBy(F.desc("load_seq")))
        closed = loads.withColumn("_nth", nth).filter(F.col("_nth") > keep).groupBy("log_source")
        bounds = closed.agg(F.max("load_seq").alias("upto")).collect()  # a row per source
        if not bounds:
            return
        merged = self.spark.createDataFrame(bounds, _MERGED)
        due = self.open_rows().join(F.broadcast(merged), "log_source").filter("load_seq <= upto").drop("upto")
        due = due if where is None else due.filter(where)
        newest = latest_per_key(due, keys, [F.col("load_seq").desc()])
        by = ["log_source", *self.partitions]
        base = self.base_rows()
        touched = base.join(F.broadcast(newest.select(*by).distinct()), by, "left_semi")
        both = touched.join(newest.select(*keys), keys, "left_anti").unionByName(newest)
        both = both.withColumnRenamed("load_seq", "base_seq")
        both.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *by
        ).parquet(f"{self.path}-base")
        self.merged.upsert(merged, time.time_ns())

    def drop_merged(self) -> None:
        """Remove the folders of merged and cleared loads: when no reader uses them any more."""
        upto = self._closed()
        loads = self.rows().select("log_source", "load_seq").distinct().collect()
        for r in loads:
            if r["load_seq"] <= upto.get(r["log_source"], -1):
                path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder(r["log_source"], r["load_seq"]))
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _read(self, folder: str, base: bool = False) -> DataFrame:
        shape, root = self._full_schema(), self.path
        if base:
            shape = T.StructType([T.StructField("base_seq", f.dataType) if f.name == "load_seq" else f for f in shape])
            root = folder
        reader = self.spark.read.option("basePath", root).schema(shape)
        try:
            rows = reader.parquet(folder)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], shape)
        return rows.withColumnRenamed("base_seq", "load_seq")

    def _full_schema(self) -> T.StructType:
        own = [f for f in self.schema if f.name not in ("log_source", "load_seq")]
        return T.StructType(
            own
            + [T.StructField("log_source", T.StringType()), T.StructField("load_seq", T.LongType())]
        )
