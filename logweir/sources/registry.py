"""Source type -> reader."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from logweir.sources.catalog import read_catalog_table
from logweir.sources.database import DIALECTS, read_table
from logweir.sources.files import read_lines
from logweir.sources.kafka import read_topic
from logweir.sources.spec import SourceSpec

FILE_KINDS = {"file", "s3", "tail"}
LINE_KINDS = {*FILE_KINDS, "kafka"}


@dataclass(frozen=True)
class Position:
    """Where a batch read goes on: the cursor and its type, and what of the files is to be read."""

    last: str | None = None
    kind: str | None = None
    files: DataFrame | None = None

    @property
    def paths(self) -> list[str]:
        """The files of the read: asked for by who looks at a load, not by the load."""
        return [] if self.files is None else [r["path"] for r in self.files.select("path").collect()]


Reader = Callable[[SparkSession, SourceSpec, Position], DataFrame]

READERS: dict[str, Reader] = {
    **{kind: lambda spark, spec, at: read_lines(spark, spec, at.files) for kind in FILE_KINDS},
    "table": lambda spark, spec, at: read_catalog_table(spark, spec, at.last, at.kind),
    "kafka": lambda spark, spec, at: read_topic(spark, spec),
    **{kind: lambda spark, spec, at: read_table(spark, spec, at.last, at.kind) for kind in DIALECTS},
}


def register_reader(kind: str, reader: Reader) -> None:
    """Add a source type; the reader gets the session, the spec and the position."""
    READERS[kind.lower()] = reader


def read_source(spark: SparkSession, spec: SourceSpec, at: Position = Position()) -> DataFrame:
    if spec.kind not in READERS:
        raise ValueError(f"[{spec.name}] unsupported source type: {spec.type}")
    return READERS[spec.kind](spark, spec, at)
