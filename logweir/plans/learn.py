"""Learn mapping rules from log files and keep them in the registry."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from logweir.constants import KEY_SYNONYMS, UNKNOWN_SOURCE
from logweir.functions.times import now_local
from logweir.operators.columns import classify_name
from logweir.operators.mapping import infer_rules, rules_as_xml
from logweir.operators.parse import first_lines, parse_lines, union_of_keys
from logweir.plans.store import Store
from logweir.sources.files import read_lines
from logweir.sources.rules import rule_list, rules_from_xml
from logweir.sources.spec import SourceSpec


def learned_rules(
    spark: SparkSession,
    path: str,
    synonyms=KEY_SYNONYMS,
    whole_files: bool = False,
) -> DataFrame:
    """Rules per source from the JSON records of classified files.

    By default the first line of each file is the sample; `whole_files` takes all lines.
    """
    files = spark.read.text(path)
    if whole_files:
        lines = files.select("value", F.col("_metadata.file_name").alias("file_name"))
    else:
        lines = first_lines(files).withColumnRenamed("line", "value")
    tagged = lines.withColumn("log_source", classify_name("file_name"))
    known = tagged.filter(F.col("log_source") != UNKNOWN_SOURCE)
    records = parse_lines(known).filter("parse_kind = 'json'")
    return infer_rules(records, synonyms=synonyms)


def learn(spark: SparkSession, store: Store, path: str, version: int, **options) -> None:
    """Upsert the learned documents into the registry."""
    documents = rules_as_xml(learned_rules(spark, path, **options))
    store.registry.upsert(documents.withColumn("updated_at", now_local()), version)


def registered_rules(store: Store, source: str) -> list[tuple[str, str]]:
    """A source's rules as kept in the registry."""
    return rule_list(rules_from_xml(store.registry.read()), source)


def discover_columns(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """(key): all keys of a source's lines, from which its columns are declared."""
    return union_of_keys(parse_lines(read_lines(spark, spec), spec.line_pattern))
