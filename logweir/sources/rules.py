"""Mapping rules kept as XML documents."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from logweir.schemas import RULE

_FIELD = "array<struct<_target:string,_source:string>>"


def _as_rules(documents: DataFrame) -> DataFrame:
    """Documents (name, field list) as one row per usable rule, in order."""
    return (
        documents.select(F.col("_name").alias("log_source"), F.posexplode("field").alias("pos", "f"))
        .select(
            "log_source", "pos", F.col("f")["_target"].alias("target"), F.col("f")["_source"].alias("source")
        )
        .filter("target IS NOT NULL AND source IS NOT NULL AND target <> '' AND source <> ''")
    )


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """(log_source, pos, target, source) from mapping files; no files give no rules."""
    try:
        documents = (
            spark.read.format("xml")
            .option("rowTag", "parser")
            .schema(f"_name string, field {_FIELD}")
            .load(path)
        )
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RULE)
    return _as_rules(documents)


def rules_from_xml(documents: DataFrame, xml_col: str = "parser_xml") -> DataFrame:
    """The same from documents held in a column, as the registry keeps them."""
    parsed = F.from_xml(F.col(xml_col), f"_name string, field {_FIELD}")
    return _as_rules(documents.select(parsed.alias("d")).select("d.*"))


def write_rules(documents: DataFrame, path: str) -> None:
    """One file per source, since a file can hold one document."""
    value = F.col("parser_xml").alias("value")
    documents.select("source_name", value).write.mode("overwrite").partitionBy(
        "source_name"
    ).text(path)


def rule_list(rules: DataFrame, source: str) -> list[tuple[str, str]]:
    """One source's rules for planning a projection: configuration-sized."""
    rows = rules.filter(F.col("log_source") == source).orderBy("pos").collect()
    return [(r["target"], r["source"]) for r in rows]
