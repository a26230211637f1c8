"""One plan from raw rows to scored events."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logweir.constants import BLANK, DEFAULT_ALERT_MESSAGE, DEFAULT_RISK_SCORE, LATE, REQUIRED_COLUMNS
from logweir.functions.text import literal, quoted
from logweir.operators.columns import (
    drop_all_null_columns,
    event_time_of,
    nan_to_null,
    standard_event,
)
from logweir.operators.enrich import enrich, person_lookup
from logweir.operators.mapping import apply_rules
from logweir.operators.parse import LineParser, parse_columns
from logweir.plans.stages import DETECTION, Stage, run_stages
from logweir.sources.registry import LINE_KINDS
from logweir.sources.spec import SourceSpec


def declared_columns(spec: SourceSpec) -> list[str]:
    """Fields of a line source that become columns; all other keys go to `extras`."""
    parser = LineParser(spec.line_pattern)
    groups = parser.pattern.names if parser.pattern else []
    ruled = [name for target, source in spec.field_rules for name in (source, target)]
    core = [c for c in REQUIRED_COLUMNS if c != "log_source"]
    names = ["final_ts", "timestamp", "raw_message", *core, *groups, *ruled, *spec.columns]
    return list(dict.fromkeys(names))


def prepared_lookup(
    people: DataFrame | None, path: str, order_col: str | None = None
) -> DataFrame | None:
    """The person lookup of one cycle, stored once; empty means none.

    Read back from its files it has a known size: Spark broadcasts it where it is small, and
    else shuffles both sides of the join by themselves, so that a hot key can be split.
    """
    if people is None:
        return None
    person_lookup(people, order_col).write.mode("overwrite").parquet(path)
    lookup = stored_lookup(people.sparkSession, path)
    return None if lookup.isEmpty() else lookup


def stored_lookup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("person_id string, person_name string").parquet(path)


def parsed_rows(raw: DataFrame, spec: SourceSpec, blank: bool = False) -> DataFrame:
    """Columns of a raw batch: lines are parsed, table rows pass."""
    if spec.kind not in LINE_KINDS:
        return nan_to_null(raw)
    return parse_columns(raw, declared_columns(spec), spec.line_pattern, extras=True, blank=blank)


def _time_error(df: DataFrame) -> Column:
    """A time that is present but unreadable makes the row unloadable."""
    reasons = [
        f"IF({quoted(c)} IS NOT NULL AND {event_time_of(df, c)} IS NULL, "
        f"concat('{c}: not a time: ', CAST({quoted(c)} AS STRING)), NULL)"
        for c in ("final_ts", "timestamp")
        if c in df.columns
    ]
    return F.expr(f"CAST(coalesce({', '.join(reasons or ['NULL'])}) AS STRING)")


def clean_events(
    raw: DataFrame,
    spec: SourceSpec,
    lookup: DataFrame | None = None,
    ingest_time: Column | None = None,
    rules=None,
    blank: bool = False,
    stage: Stage | None = None,
) -> DataFrame:
    """Parse, name, map and normalise one source's rows.

    The policy `last` takes a column even where it is null, so there the columns that are
    empty in the whole batch are dropped first, which takes a pass over it. A load gives
    `stage`, which stores the parsed rows: they are then counted and mapped from there.
    """
    rules = spec.field_rules if rules is None else rules
    rows = enrich(parsed_rows(raw, spec, blank), lookup, rules)
    rows = rows.withColumn("error_reason", _time_error(rows))
    if blank and "parse_kind" in rows.columns:
        kind = F.when(F.col("parse_kind") == BLANK, F.lit(BLANK))
        rows = rows.withColumn("error_reason", F.coalesce(kind, "error_reason"))
    if spec.mapping_policy == "last":
        rows = rows if stage is None else stage(rows)
        rows = drop_all_null_columns(rows, keep=("extras", "error_reason", "place"))
    return standard_event(apply_rules(rows, rules, spec.mapping_policy), spec.name, ingest_time)


def scored_events(
    raw: DataFrame,
    spec: SourceSpec,
    last: str | None = None,
    lookup: DataFrame | None = None,
    stages: list[Stage] | None = None,
    ingest_time: Column | None = None,
    rules=None,
    counted: bool = False,
    stage: Stage | None = None,
) -> DataFrame:
    """Clean events after the cursor, scored.

    Line sources are cut by event time here; tables were cut by their own cursor column
    when read. With `counted`, as in a load, rows that are cut and blank lines stay, marked
    by their `error_reason`, until they have been counted.
    """
    events = clean_events(raw, spec, lookup, ingest_time, rules, counted, stage)
    late = late_rows(spec, last)
    if late is not None:
        if counted:
            reason = F.coalesce("error_reason", F.when(late, F.lit(LATE)))
            events = events.withColumn("error_reason", reason)
        else:
            events = events.filter(~late)
    return run_stages(_given_scores(events), DETECTION if stages is None else stages)


def late_rows(spec: SourceSpec, last: str | None) -> Column | None:
    """Which rows of a line source are late; nothing where none can be.

    By the policy `drop` those not after the cursor. By `watermark` those that lie more than
    the delay before the newest event time of the loads before, as a watermark of Spark has
    it; a row whose time is only that of its ingest never is.
    """
    if spec.kind not in LINE_KINDS or last is None:
        return None
    cursor = F.lit(last).cast("timestamp_ntz")
    if spec.late_policy == "drop":
        return ~(F.col("final_ts") > cursor)
    if spec.late_policy == "watermark":
        bound = cursor - F.expr(f"INTERVAL {literal(spec.late_delay)}")
        return (F.col("final_ts") < bound) & ~F.coalesce("time_inferred", F.lit(False))
    return None


def _given_scores(events: DataFrame) -> DataFrame:
    """A score or message that a line brings along stands until a rule replaces it."""
    if "extras" not in events.columns:
        return events
    defaults = {
        "risk_score": (f"try_cast(extras['risk_score'] AS DOUBLE), {DEFAULT_RISK_SCORE}D"),
        "alert_message": f"extras['alert_message'], {literal(DEFAULT_ALERT_MESSAGE)}",
    }
    given = {c: F.expr(f"coalesce({v})") for c, v in defaults.items() if c not in events.columns}
    return events.withColumns(given)
