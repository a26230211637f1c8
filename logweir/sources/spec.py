"""Source descriptions and their catalog."""

import os
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from logweir.constants import EPOCH_TEXT, LINE_PATTERNS, MAPPING_RULES

DATABASE_KEYS = ["database", "dbname", "db_name", "db", "schema"]


@dataclass(frozen=True)
class SourceSpec:
    """One configured source; which fields matter depends on `type`."""

    name: str = "Unknown"
    type: str = ""
    path: str | None = None
    pattern: str | None = None
    host: str | None = None
    port: str | None = None
    database: str | None = None
    table_name: str | None = None
    query: str | None = None
    watermark_col: str | None = None
    watermark_default: str | None = None
    partition_col: str | None = None
    partition_lower: str | None = None
    partition_upper: str | None = None
    partition_count: str | None = None
    bucket: str | None = None
    prefix: str | None = None
    brokers: str | None = None
    topic: str | None = None
    columns: tuple = ()  # keys that become columns besides pattern groups and rule sources
    rules: tuple | None = None  # (target, source) pairs; None: the shipped ones
    mapping_policy: str = "last_present"
    late_policy: str = "drop"  # or "allow", or "watermark": late by more than `late_delay`
    late_delay: str = "0 seconds"
    personal: bool = False  # store the personal fields of the lines too
    people: bool = False  # the table of employee ids and names that events are named from
    unfinished: str = "take"  # a last line without a line end: take it as it is, or wait for its end
    distinct_within: str | None = None  # of equal lines that a stream meets within it, one is stored
    enabled: bool = True

    @property
    def kind(self) -> str:
        return (self.type or "").lower()

    @property
    def field_rules(self) -> list:
        return list(MAPPING_RULES.get(self.name, [])) if self.rules is None else list(self.rules)

    @property
    def line_pattern(self) -> str | None:
        """The configured pattern, else the shipped one of that name; empty means none."""
        return LINE_PATTERNS.get(self.name) if self.pattern is None else self.pattern or None

    @property
    def first_cursor(self) -> str:
        return self.watermark_default or EPOCH_TEXT

    def credentials(self) -> tuple[str | None, str | None]:
        """User and password from LOGWEIR_<NAME>_USER and _PASSWORD, never from the catalog."""
        stem = "LOGWEIR_" + "".join(c if c.isalnum() else "_" for c in self.name).upper()
        return os.environ.get(f"{stem}_USER"), os.environ.get(f"{stem}_PASSWORD")

    @classmethod
    def from_record(cls, record: dict) -> "SourceSpec":
        """A catalog record; absent keys take their defaults, the database any of its names."""
        known = {f.name for f in fields(cls)}
        given = {k: v for k, v in record.items() if k in known and v is not None}
        database = next((record[k] for k in DATABASE_KEYS if record.get(k)), None)
        if database:
            given["database"] = database
        if "columns" in given:
            given["columns"] = tuple(given["columns"])
        if "rules" in given:
            given["rules"] = tuple((r["target"], r["source"]) for r in given["rules"])
        return cls(**given)


_RULE_LIST = T.ArrayType(T.StructType().add("target", "string").add("source", "string"))
_SPECIAL = {
    "columns": T.ArrayType(T.StringType()),
    "rules": _RULE_LIST,
    "enabled": T.BooleanType(),
    "personal": T.BooleanType(),
    "people": T.BooleanType(),
}
CATALOG_SCHEMA = T.StructType(
    [
        T.StructField(n, _SPECIAL.get(n, T.StringType()))
        for n in dict.fromkeys([f.name for f in fields(SourceSpec)] + DATABASE_KEYS)
    ]
)


def read_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """All `*_sources.json` lists of a folder, enabled entries only (a missing flag means yes)."""
    records = (
        spark.read.schema(CATALOG_SCHEMA)
        .option("multiLine", True)
        .option("pathGlobFilter", "*_sources.json")
        .json(folder)
    )
    return records.filter(F.coalesce("enabled", F.lit(True)))


def load_specs(spark: SparkSession, folder: str) -> list[SourceSpec]:
    """The catalog as specs: configuration, one entry per source."""
    return [
        SourceSpec.from_record(r.asDict(recursive=True))
        for r in read_catalog(spark, folder).orderBy("name").collect()
    ]
