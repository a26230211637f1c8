"""Load one batch of one source, or all sources once."""

import logging
import time
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from logweir.functions.times import clock
from logweir.operators.behaviour import day_profiles
from logweir.operators.detect import to_notify
from logweir.plans.events import prepared_lookup, scored_events, stored_lookup
from logweir.plans.learn import learn, registered_rules
from logweir.plans.stages import Stage
from logweir.plans.store import Store
from logweir.schemas import FILES
from logweir.sinks.alerts import as_documents
from logweir.sources.files import present_files
from logweir.sources.registry import FILE_KINDS, LINE_KINDS, Position, read_source
from logweir.sources.spec import SourceSpec
from logweir.sources.tail import kept_files, planned_lines, planned_reads

log = logging.getLogger(__name__)

#: Sources of a cycle that run side by side, whatever their number.
SOURCES_AT_ONCE = 8


def load_batch(
    store: Store,
    spec: SourceSpec,
    raw: DataFrame,
    seq: int,
    lookup: DataFrame | None = None,
    stages: list[Stage] | None = None,
    rules=None,
    notify: bool = False,
    profile: bool = False,
    last: str | None = None,
    started=None,
) -> int:
    """Score a batch, write it as load `seq`, then advance the cursor and the history.

    The cursor moves only after the load is complete. A repeat of `seq` sees the cursor
    as it stood before, selects the same rows and replaces the same files. `last` is the time
    up to which rows are late; without it the saved cursor is. With `profile` the load's profiles
    of users' days are kept too.
    """
    started = started or clock()
    try:
        saved = store.cursor(spec, before=seq)
        last = saved if last is None else last
        now = F.lit(str(started))
        stage = partial(store.staged, source=spec.name, seq=seq)
        events = scored_events(raw, spec, last, lookup, stages, now, rules, counted=True, stage=stage)
        cursor_col, kind = _cursor_of(spec, raw)
        done = store.alerts.put(as_documents(events, spec.personal), spec.name, seq, saved, cursor_col, kind)
        if done["rejected"]:
            for row in store.alerts.first_errors(spec.name, seq).collect():
                log.error("[%s] rejected %s: %s", spec.name, row["row_id"], row["error_reason"])
        if notify:
            urgent = to_notify(store.alerts.load(spec.name, seq).filter("load_status = 'loaded'"))
            store.notifications.put(urgent, spec.name, seq)
        if profile:
            loaded = store.alerts.load(spec.name, seq).filter("load_status = 'loaded'")
            store.profiles.put(day_profiles(loaded), spec.name, seq)
        store.save_cursor(spec, done["cursor"] or saved, kind, seq, started)
        store.save_run(spec, seq, done, started, clock())
        return done["loaded"]
    except Exception as error:
        store.save_failure(spec, seq, str(error), started, clock())
        raise


def _cursor_of(spec: SourceSpec, raw: DataFrame) -> tuple[str, str]:
    """Cursor column and type: event time for lines, the configured column for tables."""
    if spec.kind in LINE_KINDS or spec.watermark_col not in raw.columns:
        return "final_ts", "timestamp_ntz"
    return spec.watermark_col, raw.schema[spec.watermark_col].dataType.simpleString()


def run_source(
    spark: SparkSession, store: Store, spec: SourceSpec, seq: int | None = None, **options
) -> int:
    """One batch run of one source, from its cursor on.

    Files are read once as they are: the store keeps path, length and time of those that a
    load has read, and whatever differs from that is read, however old it says it is. Of a
    `tail` source only what was added since is.
    """
    if spec.kind == "kafka":
        from logweir.streaming.ingest import run_topic  # which itself loads by load_batch

        return run_topic(spark, store, spec, **options)
    seq = int(time.time() * 1_000_000) if seq is None else seq
    started = clock()
    try:
        last, kind = store.position(spec, before=seq)
        files = file_reads(store, spec, present_files(spark, spec), seq) if spec.kind in FILE_KINDS else None
        raw = read_source(spark, spec, Position(last, kind, files))
    except Exception as error:
        store.save_failure(spec, seq, str(error), started, clock())
        raise
    loaded = load_batch(store, spec, raw, seq, last=last, started=started, **options)
    if files is not None:
        store.save_files(spec.name, kept_files(files), seq)
    return loaded


def file_reads(store: Store, spec: SourceSpec, present: DataFrame, seq: int) -> DataFrame:
    """What load `seq` reads of the present files: changed ones whole, of a `tail` source what has been added."""
    reads = planned_reads(present, store.files(spec.name, before=seq), spec.kind != "tail", spec.unfinished)
    return store.planned(reads, spec.name, seq)


def load_files(store: Store, spec: SourceSpec, present: DataFrame, seq: int, **options) -> int:
    """Load the lines of a micro-batch of files.

    Which files a stream has seen is its checkpoint's to know, so all of them are read; only of
    a `tail` source the store knows how far.
    """
    try:
        if spec.kind == "tail":
            files = file_reads(store, spec, present, seq)
        else:
            nothing = store.spark.createDataFrame([], FILES)
            files = store.planned(planned_reads(present, nothing, True, spec.unfinished), spec.name, seq)
        raw = planned_lines(files)
    except Exception as error:
        store.save_failure(spec, seq, str(error), clock(), clock())
        raise
    loaded = load_batch(store, spec, raw, seq, **options)
    store.save_files(spec.name, kept_files(files), seq)
    return loaded


def cycle_options(
    spark: SparkSession, store: Store, specs: list[SourceSpec], learn_from: str | None, seq: int
) -> dict:
    """What a cycle knows before its sources run: learned rules and the people's names.

    The source of people in the catalog is read whole, not from a cursor. A cycle goes on
    without names, or with the rules it has, where either cannot be read.
    """
    options: dict = {}
    people = next((s for s in specs if s.people), None)
    if people is not None:
        try:
            rows = read_source(spark, people)
            folder = f"{store.root}/people/{seq}"
            options["lookup"] = prepared_lookup(rows, folder)
            store.save_people(folder if options["lookup"] is not None else None, seq)
        except Exception as error:
            log.warning("[%s] no names: %s", people.name, error)
    if learn_from:
        try:
            learn(spark, store, learn_from, seq)
        except Exception as error:
            log.warning("nothing learned from %s: %s", learn_from, error)
    return options


def source_rules(store: Store, spec: SourceSpec) -> list | None:
    """What the registry holds for a source; nothing leaves its own rules in place."""
    return registered_rules(store, spec.name) or None


def side_inputs(store: Store, spec: SourceSpec, seq: int) -> dict:
    """Names and rules of the moment for load `seq`; a repeat has those its first try had."""
    people, rules = store.sides(spec.name, seq, lambda: source_rules(store, spec))
    return {"rules": rules, "lookup": stored_lookup(store.spark, people) if people else None}


def run_all(
    spark: SparkSession,
    store: Store,
    specs: list[SourceSpec],
    learn_from: str | None = None,
    at_once: int = SOURCES_AT_ONCE,
    **options,
) -> int:
    """One cycle: learn, read names, then run every source by its rules. Returns the total.

    At most `at_once` sources run side by side, each in a scheduler pool of its own name: a
    source has its own loads, cursor and files, so none waits for another's small jobs. A failing
    source is recorded and the others go on.
    """
    seq = int(time.time() * 1_000_000)
    options = {**cycle_options(spark, store, specs, learn_from, seq), **options}

    def run(spec: SourceSpec) -> int:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.name)
        try:
            own = dict(options) if "rules" in options else {**options, "rules": source_rules(store, spec)}
            return run_source(spark, store, spec, **own)
        except Exception as error:
            log.error("[%s] failed: %s", spec.name, error)
            return 0

    with ThreadPoolExecutor(max(1, min(at_once, len(specs)))) as pool:
        return sum(pool.map(inheritable_thread_target(spark)(run), specs))
