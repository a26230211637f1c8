"""Log lines from Kafka; needs the Spark Kafka connector on the class path."""

from pyspark.sql import DataFrame, SparkSession

from logweir.sources.spec import SourceSpec

# A line, and where it stands: tells apart lines that are equal and have no time of their own.
_COLUMNS = [
    "CAST(value AS STRING) AS value",
    "concat_ws(':', topic, CAST(partition AS STRING), CAST(offset AS STRING)) AS place",
]


def kafka_options(spec: SourceSpec, max_offsets=None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": spec.brokers,
        "subscribe": spec.topic,
        "startingOffsets": "earliest",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def stream_topic(spark: SparkSession, spec: SourceSpec, max_offsets=None) -> DataFrame:
    """The topic as a stream; batch runs too read it so, up to its end, from saved offsets."""
    return (
        spark.readStream.format("kafka")
        .options(**kafka_options(spec, max_offsets))
        .load()
        .selectExpr(*_COLUMNS)
    )


def read_topic(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """All that the topic holds now, as a batch."""
    options = {**kafka_options(spec), "endingOffsets": "latest"}
    return spark.read.format("kafka").options(**options).load().selectExpr(*_COLUMNS)
