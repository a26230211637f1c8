"""Log lines from files: local, distributed or object storage; batch or stream."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from logweir.schemas import FILES
from logweir.sources.spec import SourceSpec
from logweir.sources.tail import GrowingFiles, planned_lines, planned_reads

_LINES = "value string, place string"
_PRESENT = "path string, length long, modified long"
# Fixed value: the columns of Spark's reader of whole files, of which the content is not read.
_WHOLE = "path string, modificationTime timestamp, length long, content binary"


def log_path(spec: SourceSpec) -> str:
    """The glob of a file source, or of an object-store source's bucket and prefix."""
    if spec.kind == "s3":
        return f"s3a://{spec.bucket}/{spec.prefix or ''}*"
    return spec.path


def present_files(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """(path, length, modified) of the matching files as they are now; none without a match."""
    try:
        files = spark.read.format("binaryFile").load(log_path(spec))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _PRESENT)
    return _as_present(files)


def _as_present(files: DataFrame) -> DataFrame:
    return files.select("path", "length", F.unix_micros("modificationTime").alias("modified"))


def read_lines(spark: SparkSession, spec: SourceSpec, files: DataFrame | list[str] | None = None) -> DataFrame:
    """Lines as `value`, with their `place`, of the planned files, of paths, else of all matching files.

    A line's place is its file and byte offset, whatever else the batch holds.
    """
    if isinstance(files, DataFrame):
        return planned_lines(files)
    if files is not None and not files:
        return spark.createDataFrame([], _LINES)
    present = present_files(spark, spec)
    if files is not None:
        named = [f if ":/" in f else f"file:{f}" for f in files]
        present = present.filter(F.col("path").isin(named))
    return planned_lines(planned_reads(present, spark.createDataFrame([], FILES)))


def stream_files(spark: SparkSession, spec: SourceSpec, max_files=None, max_bytes=None) -> DataFrame:
    """New files of a folder as a stream of (path, length, modified); the limits bound one micro-batch.

    What is in them is read where the micro-batch is loaded, by byte ranges.
    """
    reader = spark.readStream.format("binaryFile").schema(_WHOLE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    elif max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return _as_present(reader.load(log_path(spec)))


def stream_file_lines(spark: SparkSession, spec: SourceSpec, **limits) -> DataFrame:
    """Lines of new files as a stream, with their `place`: for what has to see lines before a load does."""
    planned = planned_reads(stream_files(spark, spec, **limits), spark.createDataFrame([], FILES))
    return planned_lines(planned, tasks=int(spark.conf.get("spark.sql.shuffle.partitions")))


def stream_states(spark: SparkSession, spec: SourceSpec, max_files=None, max_bytes=None) -> DataFrame:
    """Files that grow, as a stream of (path, length, modified): a row whenever one has changed.

    The offset of the stream names every matching file with its length and time, so it is for
    sources of some thousand files at most. The limits are taken by `stream_files` alone.
    """
    spark.dataSource.register(GrowingFiles)
    return spark.readStream.format("growing_files").option("path", log_path(spec)).load()
