"""Tables of one run in the folder that all executors share, and the columns of documents."""

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import logweir
from logweir.session import shared_folder

_shipped: set[str] = set()
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, as spark-submit does."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        home = os.path.dirname(os.path.abspath(logweir.__file__))
        base = os.path.join(tempfile.mkdtemp(prefix="logweir-code-"), "logweir")
        context.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(home), os.path.basename(home)))
        _shipped.add(context.applicationId)


def run_folder(spark: SparkSession) -> str:
    """A new folder below the shared one; it belongs to the caller once the run is over."""
    return f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str) -> DataFrame:
    """The rows as a stored table, so that nothing above it is computed twice.

    What was shuffled for it leaves the executors' disks at once, not when the driver happens to
    collect its garbage.
    """
    spark = df.sparkSession
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(folder)


def remove(spark: SparkSession, folder: str, *names: str) -> None:
    """Takes away tables of a run that nothing reads any more."""
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """The two columns the operators read; a null text is the empty one."""
    ship(docs.sparkSession)
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
    )


def free_name(docs: DataFrame, name: str) -> str:
    """A column name that `docs` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name
