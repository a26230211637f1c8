"""Session settings and the shared folder for cut lineage."""

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()

# Sizes follow the data through AQE: start with many small shuffle partitions
# and let Spark merge them, split skewed ones, and choose joins at run time.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app="logweir", master=None, extra=None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as named in `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="logweir-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, as spark-submit does."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        home = os.path.dirname(os.path.abspath(__file__))
        base = os.path.join(tempfile.mkdtemp(prefix="logweir-code-"), "logweir")
        context.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(home), os.path.basename(home)))
        _shipped.add(context.applicationId)
