"""Micro-batches: new lines in, one load per batch out."""

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from logweir.constants import TRIGGER_INTERVAL
from logweir.plans.ingest import cycle_options, load_batch, load_files, side_inputs
from logweir.functions.times import clock
from logweir.plans.store import Store
from logweir.schemas import CURSOR
from logweir.sinks.slots import SlotTable
from logweir.sources.files import stream_file_lines, stream_files, stream_states
from logweir.sources.kafka import stream_topic
from logweir.sources.registry import LINE_KINDS
from logweir.sources.spec import SourceSpec
from logweir.streaming.arrivals import first_arrivals


def source_stream(spark: SparkSession, spec: SourceSpec, **limits) -> DataFrame:
    """Lines of a Kafka source as a stream; of files the files themselves, whose lines a load reads.

    With `distinct_within` it is lines in either case, and of equal ones the first to arrive.
    """
    if spec.distinct_within:
        if spec.kind == "kafka":
            return first_arrivals(stream_topic(spark, spec, **limits), spec)
        if spec.kind in ("file", "s3"):
            return first_arrivals(stream_file_lines(spark, spec, **limits), spec)
        raise ValueError(f"[{spec.name}] distinct_within: {spec.type} sources are no streams of lines")
    if spec.kind == "kafka":
        return stream_topic(spark, spec, **limits)
    if spec.kind in ("file", "s3"):
        return stream_files(spark, spec, **limits)
    if spec.kind == "tail":
        return stream_states(spark, spec, **limits)
    raise ValueError(f"[{spec.name}] {spec.type} sources run as batches")


def first_cutoff(store: Store, spec: SourceSpec, checkpoint: str) -> str:
    """The cursor as it stood when the stream of a checkpoint began."""
    kept = SlotTable(store.spark, f"{checkpoint.rstrip('/')}-cutoff", CURSOR, ["source_name"])
    row = kept.read().first()
    if row is None:
        value = store.cursor(spec)
        kept.upsert(store.spark.createDataFrame([(spec.name, value, "timestamp_ntz", clock())], CURSOR), 0)
        return value
    return row["watermark_value"]


def start_loading(
    lines: DataFrame,
    store: Store,
    spec: SourceSpec,
    checkpoint: str,
    once: bool = False,
    first_seq: int = 0,
    follow: bool = False,
    **options,
) -> StreamingQuery:
    """Load each micro-batch of `lines`; `once` stops when all present data are loaded.

    Spark commits a batch to its checkpoint after the load. A batch it repeats has the
    same id, hence replaces its own load: each line takes effect once. With a new
    checkpoint on an old store, set `first_seq` above the loads already there.

    Where the stream stands is the checkpoint's to know. Rows are late only against the
    cursor as it stood when the checkpoint was new, which is kept beside it: how a backlog is
    cut into batches, or how often the stream is restarted, does not decide what is kept. Only by
    the policy `watermark` the bound follows the newest event time of the batches before, less
    the source's delay.

    With `follow` each micro-batch takes the names and the learned rules that stand in the store
    as it begins, unless `options` fix them; they are recorded with the load, and a repeated batch
    has them again.
    """
    late_until = first_cutoff(store, spec, checkpoint)

    def load(batch: DataFrame, batch_id: int) -> None:
        whole = load_batch if "value" in batch.columns else load_files
        seq = first_seq + batch_id
        # a watermark moves with the batches; a repeated one sees it as it stood before
        until = store.cursor(spec, before=seq) if spec.late_policy == "watermark" else late_until
        sides = side_inputs(store, spec, seq) if follow else {}
        if spec.distinct_within:  # the state is read and written once
            batch = store.staged(batch, spec.name, seq, "arrived")
        whole(store, spec, batch, seq, last=until, **{**sides, **options})

    writer = (
        lines.writeStream.queryName(spec.name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(load)
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(
        processingTime=TRIGGER_INTERVAL
    )
    return writer.start()


def start_all(
    spark: SparkSession,
    store: Store,
    specs: list[SourceSpec],
    checkpoint: str,
    limits: dict | None = None,
    learn_from: str | None = None,
    running: dict[str, StreamingQuery] | None = None,
    **options,
) -> dict[str, StreamingQuery]:
    """One query per source of lines, so that a failing source stops alone.

    `limits` (max_files or max_bytes, for Kafka max_offsets) bounds a micro-batch, so that
    a backlog is loaded in pieces. Given the result of an earlier call as `running`, only
    sources whose query has ended are started again, from their checkpoints: calling it on a
    timer retries failed sources in the next cycle. Each call reads the names, and learns the
    rules, anew; queries that run take them from their next micro-batch on.
    """
    root, running = checkpoint.rstrip("/"), dict(running or {})
    cycle_options(spark, store, specs, learn_from, int(time.time() * 1_000_000))
    for spec in specs:
        if spec.kind not in LINE_KINDS or (spec.name in running and running[spec.name].isActive):
            continue
        lines = source_stream(spark, spec, **(limits or {}))
        running[spec.name] = start_loading(lines, store, spec, f"{root}/{spec.name}", follow=True, **options)
    return running


def run_topic(spark: SparkSession, store: Store, spec: SourceSpec, **options) -> int:
    """A batch run over what a topic has got since the last one; its offsets are a checkpoint."""
    before = store.loaded_count(spec.name)
    lines = source_stream(spark, spec)
    query = start_loading(lines, store, spec, f"{store.root}/offsets/{spec.name}", once=True, **options)
    query.awaitTermination()
    return store.loaded_count(spec.name) - before
