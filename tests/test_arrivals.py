"""Counts taken as a load is written, and equal lines that a stream stores once."""

import time

import pytest
from pyspark.sql import functions as F

from logweir.plans.store import Store
from logweir.sinks.alerts import AlertIndex, as_documents
from logweir.sources.spec import SourceSpec
from logweir.streaming.ingest import source_stream, start_loading

TIMED = '{"timestamp":"2026-01-01 00:00:%02d","action":"login"}'
UNTIMED = '{"action":"error"}'


@pytest.fixture
def stream(spark, tmp_path):
    """Runs a stream over the folder's files to their end; gives the last progress with state."""
    (tmp_path / "logs").mkdir()
    store = Store(spark, f"{tmp_path}/store")

    def run(within, **changes):
        spec = SourceSpec(**{"name": "Auth_Logs", "type": "file", "path": f"{tmp_path}/logs", "late_policy": "allow", "distinct_within": within, **changes})
        query = start_loading(source_stream(spark, spec), store, spec, f"{tmp_path}/checkpoint", once=True)
        query.awaitTermination()
        return query.recentProgress

    def write(name, *lines):
        (tmp_path / "logs" / name).write_text("".join(f"{line}\n" for line in lines))

    return store, write, run


def _stored(store):
    return store.alerts.open_rows().filter("load_status = 'loaded'")


def _times(store):
    return sorted(r["s"] for r in _stored(store).filter("NOT time_inferred").select(F.second("final_ts").alias("s")).collect())


def test_counts_of_the_write_are_those_of_the_files(spark, tmp_path):
    index = AlertIndex(spark, str(tmp_path))
    shape = "log_source string, final_ts timestamp_ntz, time_inferred boolean, action string, error_reason string"
    empty = spark.createDataFrame([], shape)
    events = spark.range(0, 1000, 1, 8).select(
        F.lit("s").alias("log_source"), F.expr("TIMESTAMP_NTZ'2026-01-01' + make_interval(0, 0, 0, 0, 0, 0, id)").alias("final_ts"),
        (F.col("id") > 900).alias("time_inferred"), F.col("id").cast("string").alias("action"),
        F.expr("CASE WHEN id % 10 = 0 THEN 'final_ts: bad' WHEN id % 10 = 1 THEN 'late' WHEN id = 5 THEN 'blank' END").alias("error_reason"),
    )
    for seq, rows in enumerate((events, events.filter("id < 0"), empty)):
        done = index.put(as_documents(rows), "s", seq, "2025-01-01 00:00:00")
        assert done == index.summary("s", seq, "2025-01-01 00:00:00").asDict()
    done = index.put(as_documents(events), "s", 0)
    assert (done["loaded"], done["rejected"], done["late"], done["blank"]) == (799, 100, 100, 1)
    assert done["cursor"] == "2026-01-01 00:15:00"  # a rejected row has a time too


def test_a_line_in_two_files_is_stored_once(stream):
    store, write, run = stream
    write("a.log", TIMED % 1, TIMED % 1, TIMED % 2, UNTIMED, UNTIMED, "", '{"timestamp":"no time","action":"x"}')
    run("1 day")
    write("b.log", TIMED % 2, TIMED % 3, UNTIMED, "", '{"timestamp":"no time","action":"x"}')
    progress = run("1 day")
    assert _times(store) == [1, 2, 3]
    assert _stored(store).filter("time_inferred").count() == 3
    runs = store.history().agg(F.sum("processed_count").alias("n"), F.sum("blank_count").alias("blank")).first()
    assert (runs["n"], runs["blank"]) == (6, 2)
    assert store.alerts.open_rows().filter("load_status = 'rejected'").count() == 2
    left_out = sum(p["stateOperators"][0]["customMetrics"]["numDroppedDuplicateRows"] for p in progress)
    assert left_out == 1


def test_state_holds_the_lines_of_the_delay(stream):
    store, write, run = stream
    write("a.log", *[TIMED % s for s in range(20)])
    held = max(p["stateOperators"][0]["numRowsTotal"] for p in run("2 seconds"))
    assert held == 20
    time.sleep(5)
    write("b.log", TIMED % 30)
    assert run("2 seconds")[-1]["stateOperators"][0]["numRowsTotal"] <= 1
    time.sleep(5)
    write("c.log", TIMED % 1)
    run("2 seconds")
    # beyond the delay it is stored again, and the index shows one of the two
    assert _times(store).count(1) == 2
    assert store.alerts.alerts().count() == 21


def test_old_times_are_not_too_late_for_the_state(stream):
    store, write, run = stream
    write("a.log", TIMED % 50)
    run("1 day")
    write("b.log", '{"timestamp":"2020-01-01 00:00:07","action":"login"}')
    run("1 day")
    assert _times(store) == [7, 50]


def test_the_policy_that_looks_at_the_batch_is_allowed(stream):
    store, write, run = stream
    write("a.log", TIMED % 1, TIMED % 1)
    run("1 day", mapping_policy="last")
    assert _times(store) == [1]


def test_files_that_grow_are_no_streams_of_lines(spark, tmp_path):
    spec = SourceSpec(name="s", type="tail", path=str(tmp_path), distinct_within="1 day")
    with pytest.raises(ValueError, match="distinct_within"):
        source_stream(spark, spec)
