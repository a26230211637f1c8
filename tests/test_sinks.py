import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.constants import EPOCH_TEXT
from logweir.operators.keyed import conform
from logweir.plans.store import Store
from logweir.schemas import ALERT_DOC, REGISTRY, alert_table
from logweir.sinks.alerts import (
    TABLE_PARTS,
    AlertIndex,
    _same_times,
    as_documents,
    create_alert_table,
    insert_alerts,
    merge_by_id,
    reset_index,
    truncate_table,
    write_json_lines,
)
from logweir.sinks.loads import LoadTable
from logweir.sinks.slots import SlotTable
from logweir.sources.spec import SourceSpec

SHAPE = T.StructType().add("k", "string").add("v", "integer").add("day", "string")


def _rows(spark, data):
    return spark.createDataFrame(data, SHAPE)


def test_a_repeated_load_replaces_itself(spark, tmp_path):
    table = LoadTable(spark, str(tmp_path), SHAPE, ["day"])
    table.put(_rows(spark, [("a", 1, "d1"), ("b", 1, "d2")]), "s", 1)
    table.put(_rows(spark, [("a", 2, "d1")]), "s", 2)
    table.put(_rows(spark, [("x", 9, "d1")]), "s", 2)
    table.put(_rows(spark, [("x", 10, "d3")]), "t / 이름=1", 2)
    got = {(r["log_source"], r["load_seq"], r["k"], r["v"]) for r in table.rows().collect()}
    assert got == {("s", 1, "a", 1), ("s", 1, "b", 1), ("s", 2, "x", 9), ("t / 이름=1", 2, "x", 10)}
    assert [r["k"] for r in table.load("s", 2).collect()] == ["x"]


def test_newest_row_of_a_key_and_compaction(spark, tmp_path):
    table = LoadTable(spark, f"{tmp_path}/a", SHAPE, ["day"])
    table.put(_rows(spark, [("a", 1, "d1"), ("b", 1, "d1")]), "s", 1)
    table.put(_rows(spark, [("a", 2, "d1")]), "s", 2)
    want = {("a", 2), ("b", 1)}
    assert {(r["k"], r["v"]) for r in table.latest(["log_source", "k"]).collect()} == want
    keys = ["log_source", "k"]
    shown = lambda: {(r["k"], r["v"]) for r in table.latest(keys).collect()}
    table.merge(keys)
    assert table.base_rows().count() == 2 and shown() == want  # the newest load stays open
    table.put(_rows(spark, [("b", 3, "d1"), ("c", 1, "d2")]), "s", 3)
    table.merge(keys)
    assert shown() == {("a", 2), ("b", 3), ("c", 1)}
    assert {r["load_seq"] for r in table.open_rows().collect()} == {3}
    table.merge(keys)  # nothing left to do
    table.drop_merged()
    assert {r["load_seq"] for r in table.rows().collect()} == {3} and shown() == {("a", 2), ("b", 3), ("c", 1)}
    table.put(_rows(spark, [("x", 1, "d9")]), "t / 이름=1", 1)
    table.merge(keys, keep=0)
    table.drop_merged()
    assert table.rows().isEmpty() and shown() == {("a", 2), ("b", 3), ("c", 1), ("x", 1)}


def test_merging_again_after_a_failure_gives_the_same_rows(spark, tmp_path, monkeypatch):
    table = LoadTable(spark, str(tmp_path), SHAPE, ["day"])
    for seq in (1, 2, 3):
        table.put(_rows(spark, [("a", seq, "d1"), (f"k{seq}", seq, f"d{seq}")]), "s", seq)
    want = sorted(map(tuple, table.latest(["k"]).select("k", "v").collect()))

    def die(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(table.merged, "upsert", die)
        with pytest.raises(RuntimeError):
            table.merge(["k"])
    assert sorted(map(tuple, table.latest(["k"]).select("k", "v").collect())) == want
    table.merge(["k"])
    assert sorted(map(tuple, table.latest(["k"]).select("k", "v").collect())) == want


def test_empty_table_reads_empty(spark, tmp_path):
    table = LoadTable(spark, f"{tmp_path}/none", SHAPE, ["day"])
    assert table.rows().isEmpty()
    table.put(_rows(spark, []), "s", 1)
    assert table.load("s", 1).isEmpty() and table.rows().isEmpty()


def _registry_row(spark, name, xml):
    return spark.createDataFrame([(name, xml, dt.datetime(2026, 1, 1))], REGISTRY)


def test_slots_keep_the_content_of_a_failed_write(spark, tmp_path):
    table = SlotTable(spark, str(tmp_path / "r"), REGISTRY, ["source_name"])
    assert table.read().isEmpty()
    table.upsert(_registry_row(spark, "a", "1"), 1)
    table.upsert(_registry_row(spark, "b", "1"), 2)
    table.upsert(_registry_row(spark, "a", "2"), 3)
    table.upsert(_registry_row(spark, "a", "2"), 3)
    content = lambda t: {(r["source_name"], r["parser_xml"]) for r in t.read().collect()}
    assert content(table) == {("a", "2"), ("b", "1")}
    assert {r["parser_xml"] for r in table.read(before=3).collect()} == {"1"}

    class Broken(Exception):
        pass

    def fail(_):
        raise Broken()

    boom = F.udf(fail, "string")
    with pytest.raises(Exception):
        table.upsert(_registry_row(spark, "a", "9").withColumn("parser_xml", boom("source_name")), 4)
    assert content(table) == {("a", "2"), ("b", "1")}
    table.upsert(_registry_row(spark, "c", "1"), 4)
    assert content(table) == {("a", "2"), ("b", "1"), ("c", "1")}


def _events(spark, data):
    return spark.createDataFrame(
        data,
        "log_source string, final_ts timestamp_ntz, time_inferred boolean, user_id string, action string, "
        "risk_score double, extras map<string,string>, error_reason string",
    ).withColumn("port", F.lit(443))


T1 = dt.datetime(2026, 1, 1, 10)


def test_documents_fold_other_columns(spark):
    df = _events(spark, [("s", T1, False, "E1", "a", 10.0, {"bytes_total": "12", "z": None, "q": "1", "dst_port": "x"}, None)])
    doc = as_documents(df).first()
    assert doc["extras"] == {"port": "443", "q": "1"}
    assert (doc["bytes_total"], doc["dst_port"], doc["src_port"]) == (12.0, 0.0, None)
    declared = as_documents(
        df.withColumns({"bytes_total": F.lit("12"), "q": F.lit("1")})
        .withColumn("extras", F.map_filter("extras", lambda k, _: ~k.isin("bytes_total", "q")))
    ).first()
    assert declared["row_id"] == doc["row_id"] and declared["extras"] == doc["extras"]


def test_index_keeps_one_document_per_id(spark, tmp_path):
    index = AlertIndex(spark, str(tmp_path))
    first = [("s", T1, False, "E1", "Login", 10.0, {}, None), ("s", T1, False, "E2", "x", 10.0, {}, "final_ts: bad")]
    index.put(as_documents(_events(spark, first)), "s", 1)
    again = [("s", T1, False, "E1", "login", 10.0, {}, None), ("s", None, True, "E3", "y", 10.0, {}, None)]
    index.put(as_documents(_events(spark, again)), "s", 2)
    assert {(r["user_id"], r["action"]) for r in index.alerts().collect()} == {("E1", "login"), ("E3", "y")}
    assert [r["error_reason"] for r in index.rejects().collect()] == ["final_ts: bad"]
    assert index.first_errors("s", 1).count() == 1
    done = index.summary("s", 1)
    assert (done["loaded"], done["rejected"], done["cursor"]) == (1, 1, "2026-01-01 10:00:00")
    assert index.summary("s", 2, "7", "port", "int")["cursor"] == "443"
    assert index.summary("s", 1, "2027-01-01 00:00:00")["cursor"] == "2027-01-01 00:00:00"
    before = sorted(r["row_id"] for r in index.alerts().collect())
    index.merge(keep=0)
    assert index.open_rows().isEmpty() and index.rejects().count() == 1
    assert sorted(r["row_id"] for r in index.alerts().collect()) == before
    assert index.documents().filter("user_id = 'E1'").first()["final_ts"] == "2026-01-01T10:00:00+09:00"


def test_rows_without_all_columns_are_loaded_and_counted(spark, tmp_path):
    index = AlertIndex(spark, str(tmp_path))
    rows = spark.createDataFrame(
        [("b", T1, "final_ts: bad"), (None, T1, "no id"), ("a", None, "bytes_total: bad"), ("c", T1, None)],
        "row_id string, final_ts timestamp_ntz, error_reason string",
    )
    done = index.put(rows, "s", 1, "2025-01-01 00:00:00")
    assert (done["loaded"], done["rejected"], done["late"], done["blank"]) == (1, 3, 0, 0)
    assert done == index.summary("s", 1, "2025-01-01 00:00:00").asDict()
    assert [r["row_id"] for r in index.first_errors("s", 1).collect()] == ["a", "b", None]


def test_filters_on_the_index_prune_its_folders(spark, tmp_path):
    index = AlertIndex(spark, str(tmp_path))
    index.put(as_documents(_events(spark, [("s", T1, False, "E1", "a", 10.0, {}, None)])), "s", 1)
    one_day = index.alerts().filter("log_source = 's' AND event_date = DATE '2026-01-01'")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):]
    assert "event_date" in filters and "log_source" in filters and "load_status" in filters


def test_relational_table(spark, tmp_path):
    create_alert_table(spark, "alert_rows")
    batch = spark.createDataFrame(
        [("2026-01-01 00:00:00", "E1", "1", "s", "a"), ("2026-01-01 00:00:00", "E1", "1", "s", "a"),
         ("2026-01-01 00:00:00", None, "1", "s", "b")],
        "final_ts string, emp_id string, src_ip string, log_source string, action string",
    )
    staging = f"{tmp_path}/staging"
    insert_alerts(spark, "alert_rows", batch, staging, 1)
    insert_alerts(spark, "alert_rows", batch, staging, 1)  # a retry: rows with a null key part too
    insert_alerts(spark, "alert_rows", batch.filter("emp_id IS NOT NULL"), staging, 2)
    got = sorted(r["action"] for r in spark.table("alert_rows").collect())
    assert got == ["a", "b"]
    assert spark.table("alert_rows").schema.fieldNames() == [*alert_table().fieldNames(), *TABLE_PARTS]
    part = _same_times(spark.table("alert_rows"), conform(batch, alert_table()), ["final_ts"])
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(final_ts" in plan and "alert_date" in plan[plan.index("PartitionFilters"):]
    insert_alerts(spark, "alert_rows", batch.limit(0), staging, 3)
    assert spark.table("alert_rows").count() == 2
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    insert_alerts(spark, "alert_rows", batch.mapInArrow(counted, batch.schema), staging, 4)
    assert seen.value == 3 and spark.table("alert_rows").count() == 3
    truncate_table(spark, "alert_rows")
    assert spark.table("alert_rows").isEmpty()
    with pytest.raises(Exception):
        merge_by_id(batch.withColumn("row_id", F.lit("x")), "alert_rows", "emp_id")
    spark.sql("DROP TABLE alert_rows")


def test_reset_and_json_lines(spark, tmp_path):
    path = str(tmp_path / "i")
    spark.range(3).write.parquet(path)
    reset_index(spark, path, ALERT_DOC)
    assert spark.read.parquet(path).isEmpty()
    out = str(tmp_path / "j")
    for _ in range(2):
        write_json_lines(spark.createDataFrame([("홍길동", 1)], "user string, n int"), out)
    assert [r[0] for r in spark.read.text(out).collect()] == ['{"user":"홍길동","n":1}'] * 2


def test_position_of_a_source(spark, tmp_path):
    """The saved cursor with its type; a saved epoch, or none, gives way to the default."""
    store = Store(spark, str(tmp_path))
    now = dt.datetime(2026, 1, 1)
    saved = SourceSpec(name="a", watermark_default="0")
    store.save_cursor(saved, "EMP001", "string", 1, now)
    begun = SourceSpec(name="b", watermark_default="0")
    store.save_cursor(begun, EPOCH_TEXT, "timestamp_ntz", 1, now)
    assert store.position(saved) == ("EMP001", "string") and store.position(saved, before=1) == ("0", None)
    assert store.position(begun) == ("0", None)
    assert store.position(SourceSpec(name="c")) == (EPOCH_TEXT, None)
