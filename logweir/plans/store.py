"""Where a deployment keeps its results and state."""

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from logweir.constants import EPOCH_TEXT
from logweir.schemas import CURSOR, FILES, HISTORY, PEOPLE, PROFILE, READS, REGISTRY, SIDES
from logweir.operators.behaviour import behaviour_scores, merged_profiles
from logweir.sinks.alerts import AlertIndex
from logweir.sinks.loads import LoadTable, folder_name
from logweir.sinks.slots import SlotTable
from logweir.sources.spec import SourceSpec


class Store:
    """Alerts, notifications, cursors, mapping registry and run history under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.alerts = AlertIndex(spark, f"{self.root}/alerts")
        self.notifications = AlertIndex(spark, f"{self.root}/notifications")
        self.registry = SlotTable(spark, f"{self.root}/registry", REGISTRY, ["source_name"])
        self._history = LoadTable(spark, f"{self.root}/history", HISTORY)
        self._files = LoadTable(spark, f"{self.root}/files", FILES)
        self.profiles = LoadTable(spark, f"{self.root}/profiles", PROFILE)
        self._people = SlotTable(spark, f"{self.root}/people-now", PEOPLE, ["name"])
        self._sides = LoadTable(spark, f"{self.root}/sides", SIDES)
        self._plans = LoadTable(spark, f"{self.root}/plans", READS)

    def cursors(self, source: str) -> SlotTable:
        """One table per source, so that sources can run side by side."""
        return SlotTable(self.spark, f"{self.root}/cursors/{folder_name(source)}", CURSOR, ["source_name"])

    def cursor(self, spec: SourceSpec, before: int | None = None) -> str:
        """Saved value, else the source's default, else the epoch."""
        return self.position(spec, before)[0]

    def position(self, spec: SourceSpec, before: int | None = None) -> tuple[str, str | None]:
        """The cursor and its type; without a saved one the default, of no known type."""
        row = self.cursors(spec.name).read(before).first()
        if row is None or row["watermark_value"] in (None, EPOCH_TEXT):
            return spec.first_cursor, None
        return row["watermark_value"], row["watermark_type"]

    def files(self, source: str, before: int | None = None) -> DataFrame:
        """Each file of a source as the newest load (of those before `before`) has read it."""
        own = F.col("log_source") == source
        own = own if before is None else own & (F.col("load_seq") < before)
        return self._files.latest(["log_source", "path"], own).select(*FILES.fieldNames())

    def planned(self, reads: DataFrame, source: str, seq: int) -> DataFrame:
        """What a load is to read of its files, fixed: a file that grows meanwhile is read on by the next load."""
        self._plans.put(reads, source, seq)
        return self._plans.load(source, seq).select(*READS.fieldNames())

    def save_files(self, source: str, files: DataFrame, seq: int) -> None:
        self._files.put(files, source, seq)

    def save_cursor(self, spec: SourceSpec, value: str, kind: str, seq: int, now) -> None:
        row = self.spark.createDataFrame([(spec.name, value, kind, now)], CURSOR)
        self.cursors(spec.name).upsert(row, seq)

    def save_run(self, spec: SourceSpec, seq: int, done, started, now) -> None:
        """The history row of a finished load; a repeated load replaces its row.

        Loaded, rejected, late and blank rows add up to the lines that were read.
        """
        counts = (done["loaded"], done["rejected"], done["late"], done["blank"])
        self._put_run(spec, seq, f"{spec.name}-{seq}", counts, "SUCCESS", None, started, now)

    def save_failure(self, spec: SourceSpec, seq: int, error: str, started, now) -> None:
        """The history row of a failed try; it stays when the load later succeeds."""
        own = int(time.time() * 1_000_000)
        run_id = f"{spec.name}-{seq}-{own}"
        self._put_run(spec, own, run_id, (0, 0, 0, 0), "FAIL", error, started, now)

    def _put_run(self, spec, seq, run_id, counts, status, error, started, now):
        row = (run_id, spec.name, "alerts", *counts, status, error, started, now)
        self._history.put(self.spark.createDataFrame([row], HISTORY), spec.name, seq)

    def save_people(self, folder: str | None, version: int) -> None:
        """Where the names of the moment are; none where there are none."""
        self._people.upsert(self.spark.createDataFrame([("people", folder)], PEOPLE), version)

    def sides(self, source: str, seq: int, rules) -> tuple[str | None, list | None]:
        """Folder of names and rules of a load; the first try records those of the moment, a repeat has them again.

        `rules` is called where nothing is recorded yet.
        """
        kept = self._sides.load(source, seq).first()
        if kept is None:
            people = self._people.read().first()
            row = (people and people["folder"], rules() or [])
            self._sides.put(self.spark.createDataFrame([row], SIDES), source, seq)
            return row[0], row[1] or None
        return kept["people"], [(r["target"], r["source"]) for r in kept["rules"]] or None

    def behaviour(self, days: int = 14) -> DataFrame:
        """Scores of each user's days by the profiles of all loads."""
        return behaviour_scores(merged_profiles(self.profiles.open_rows()), days)

    def staged(self, rows: DataFrame, source: str, seq: int, name: str = "staging") -> DataFrame:
        """Rows of a load as stored, so that reading them twice computes them once."""
        table = LoadTable(self.spark, f"{self.root}/{name}", rows.drop("log_source", "load_seq").schema)
        table.put(rows, source, seq)
        return table.load(source, seq).select(*rows.columns)

    def loaded_count(self, source: str) -> int:
        """Rows that all loads of a source have stored, by the history."""
        runs = self.history().filter(F.col("source_name") == source)
        return runs.agg(F.coalesce(F.sum("processed_count"), F.lit(0))).first()[0]

    def history(self) -> DataFrame:
        """One row per run; merged runs come from a few files, whatever their number."""
        return self._history.latest(["log_source", "id"]).select(*HISTORY.fieldNames())

    def merge(self, keep: int = 1) -> None:
        """Bound what readers list: closed loads, runs and file lists into their bases."""
        self.alerts.merge(keep)
        self.notifications.merge(keep)
        self._history.merge(["log_source", "id"], keep)
        self._files.merge(["log_source", "path"], keep)
