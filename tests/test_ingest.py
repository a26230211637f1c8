import datetime as dt
import json
import os
from dataclasses import replace

import pytest

from logweir.operators.totals import run_report
from logweir.plans.events import prepared_lookup, scored_events
from logweir.plans import ingest
from logweir.plans.ingest import load_batch, run_all, run_source
from logweir.plans.learn import discover_columns, learn, learned_rules, registered_rules
from logweir.plans.store import Store
from logweir.sources.registry import READERS, register_reader
from logweir.sources.spec import SourceSpec
from logweir.streaming import ingest as streaming
from logweir.streaming.ingest import source_stream, start_all, start_loading


def line(second, user="E1", action="login", **more):
    return json.dumps({"timestamp": f"2026-01-01T00:00:{second:02d}", "user_id": user, "action": action, **more})


@pytest.fixture
def place(spark, tmp_path):
    (tmp_path / "logs").mkdir()

    def write(name, *lines):
        (tmp_path / "logs" / name).write_text("\n".join(lines) + "\n", encoding="utf-8")

    spec = SourceSpec(name="Auth_Logs", type="file", path=f"{tmp_path}/logs")
    return write, spec, Store(spark, str(tmp_path / "store")), str(tmp_path / "checkpoint")


def loaded(store):
    return sorted((r["timestamp"][-2:], r["action"]) for r in store.alerts.alerts().collect())


def test_batches_add_up_to_one_full_batch(spark, place, tmp_path):
    write, spec, store, _ = place
    lines = [line(i, f"E{i % 3}", ip="10.0.0.1") for i in range(1, 13)]
    for n, part in enumerate((lines[:4], lines[:8], lines)):
        write("a.log", *part)
        assert run_source(spark, store, spec, seq=n + 1) == 4
    whole = Store(spark, str(tmp_path / "whole"))
    assert run_source(spark, whole, spec, seq=1) == 12
    key = lambda s: sorted(r["row_id"] for r in s.alerts.alerts().collect())
    assert key(store) == key(whole) and len(key(store)) == 12
    assert store.cursor(spec) == "2026-01-01 00:00:12"
    assert run_source(spark, store, spec, seq=9) == 0
    assert store.cursor(spec) == "2026-01-01 00:00:12"


def test_ties_and_late_rows_are_dropped_or_allowed(spark, place):
    write, spec, store, _ = place
    write("a.log", line(5))
    run_source(spark, store, spec, seq=1)
    write("a.log", line(5), line(5, action="tie"), line(3, action="late"), line(6, action="new"))
    run_source(spark, store, spec, seq=2)
    assert loaded(store) == [("05", "login"), ("06", "new")]
    open_spec = SourceSpec(name=spec.name, type="file", path=spec.path, late_policy="allow")
    assert run_source(spark, store, open_spec, seq=3) == 0  # the file is as it was read
    write("a.log", line(5), line(5), line(5, action="tie"), line(3, action="late"), line(6, action="new"))
    run_source(spark, store, open_spec, seq=4)
    assert loaded(store) == [("03", "late"), ("05", "login"), ("05", "tie"), ("06", "new")]


def test_files_are_read_once_however_old_they_say_they_are(spark, place, tmp_path, monkeypatch):
    write, spec, store, _ = place
    spec = replace(spec, late_policy="allow")
    opened = []
    whole = ingest.read_source
    monkeypatch.setattr(ingest, "read_source", lambda s, x, at: opened.append(sorted(map(os.path.basename, at.paths))) or whole(s, x, at))
    write("a.log", line(5))
    assert run_source(spark, store, spec, seq=1) == 1
    write("moved.log", line(3), line(4))  # as a restored file, older than the load before
    for name, when in (("moved.log", dt.datetime(2020, 1, 1)), ("a.log", dt.datetime(2100, 1, 1))):
        os.utime(tmp_path / "logs" / name, (when.timestamp(),) * 2)
    assert run_source(spark, store, spec, seq=2) == 3
    assert run_source(spark, store, spec, seq=3) == 0
    write("a.log", line(5), line(6))  # grown
    assert run_source(spark, store, spec, seq=4) == 2
    (tmp_path / "more").mkdir()
    (tmp_path / "more" / "b.log").write_text(line(1) + "\n")
    wider = replace(spec, path=f"{tmp_path}/{{logs,more}}")
    assert run_source(spark, store, wider, seq=5) == 1
    assert opened == [["a.log"], ["a.log", "moved.log"], [], ["a.log"], ["b.log"]]
    assert [s for s, _ in loaded(store)] == ["01", "03", "04", "05", "06"]
    store.merge(keep=0)
    assert run_source(spark, store, wider, seq=6) == 0


def test_a_failed_load_reads_its_files_again(spark, place, monkeypatch):
    write, spec, store, _ = place
    write("a.log", line(1), line(2))
    with monkeypatch.context() as patched:
        patched.setattr(Store, "save_files", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run_source(spark, store, replace(spec, late_policy="allow"), seq=1)
    run_source(spark, store, replace(spec, late_policy="allow"), seq=2)
    assert loaded(store) == [("01", "login"), ("02", "login")]


def test_every_line_is_accounted_for(spark, place):
    write, spec, store, _ = place
    write("a.log", line(5), "", " \t", "text without a time", line(4, user="E9"), json.dumps({"timestamp": "yesterday"}))
    run_source(spark, store, spec, seq=1)
    write("b.log", line(5), line(6), "")
    run_source(spark, store, spec, seq=2)
    counts = {r["id"]: (r["processed_count"], r["failed_count"], r["late_count"], r["blank_count"]) for r in store.history().collect()}
    # a text without any time has the epoch, which the first cursor is
    assert counts == {"Auth_Logs-1": (2, 1, 1, 2), "Auth_Logs-2": (1, 0, 1, 1)}
    assert loaded(store) == [("04", "login"), ("05", "login"), ("06", "login")]
    assert store.alerts.rows().filter("load_status IN ('late', 'blank') AND raw_message IS NOT NULL").isEmpty()


def test_equal_lines_without_a_time_stay_apart(spark, place):
    write, spec, store, _ = place
    fire = replace(spec, name="Firewall_Logs")
    text = "[allow] src=10.0.0.1 dst=10.0.0.2 dst_port=443 proto=TCP service=Jira bytes=512"
    write("a.log", *[text] * 50)
    assert run_source(spark, store, fire, seq=1) == 50
    rows = store.alerts.alerts()
    assert rows.count() == 50 and rows.select("event_date").distinct().count() == 1
    assert rows.first()["event_date"].year > 2000
    run_source(spark, store, fire, seq=1)  # a repeat replaces the load
    assert store.alerts.alerts().count() == 50


def test_personal_fields_are_left_out(spark, place, tmp_path):
    write, spec, store, _ = place
    write("a.log", line(1, ssn="1-2", phone="7"), line(2))
    run_source(spark, store, spec, seq=1)
    plain = {r["timestamp"][-2:]: r for r in store.alerts.alerts().collect()}
    assert not {"ssn", "phone"} & set(plain["01"]["extras"])
    write("a.log", line(1, ssn="9-9"), line(2))
    other = Store(spark, f"{tmp_path}/other")
    run_source(spark, other, replace(spec, personal=True), seq=1)
    asked = {r["timestamp"][-2:]: r for r in other.alerts.alerts().collect()}
    assert asked["01"]["extras"]["ssn"] == "9-9" and asked["01"]["row_id"] == plain["01"]["row_id"]


def test_unloadable_and_untimed_rows(spark, place):
    write, spec, store, _ = place
    write("a.log", json.dumps({"timestamp": "yesterday", "user_id": "E1"}), json.dumps({"user_id": "E2"}), line(7))
    assert run_source(spark, store, spec, seq=1) == 2
    assert run_source(spark, store, spec, seq=2) == 0  # the file has been read
    assert store.alerts.alerts().count() == 2
    assert store.alerts.rejects().first()["error_reason"] == "timestamp: not a time: yesterday" or \
        store.alerts.rejects().first()["error_reason"].startswith("final_ts: not a time")
    assert store.cursor(spec) == "2026-01-01 00:00:07"
    failed = {r["id"]: r["failed_count"] for r in store.history().collect()}
    assert failed == {"Auth_Logs-1": 1, "Auth_Logs-2": 0}


def test_a_failing_source_stops_alone(spark, place):
    write, spec, store, _ = place
    write("a.log", line(1, action="SSH_BruteForce"), line(2, action="Reverse_Shell_C2"))
    bad = SourceSpec(name="Bad", type="oracle")
    assert run_all(spark, store, [bad, spec], notify=True) == 2
    status = {r["source_name"]: (r["status"], r["processed_count"]) for r in store.history().collect()}
    assert status == {"Bad": ("FAIL", 0), "Auth_Logs": ("SUCCESS", 2)}
    assert run_report(store.history()).count() == 2
    assert [r["action"] for r in store.notifications.alerts().collect()] == ["Reverse_Shell_C2"]


def test_names_and_given_scores(spark, place, rows):
    write, spec, store, _ = place
    write("a.log", line(1, user="1"), line(2, user="2", risk_score=55.5, bytes_total="x", duration=3))
    lookup = prepared_lookup(rows([("1", "Kim")], "emp_id string, emp_name string"), f"{store.root}/p")
    assert prepared_lookup(None, f"{store.root}/q") is None
    assert prepared_lookup(rows([], "emp_id string, emp_name string"), f"{store.root}/r") is None
    run_source(spark, store, spec, seq=1, lookup=lookup)
    got = {r["user_id"]: r for r in store.alerts.alerts().collect()}
    assert got["1"]["emp_name"] == "Kim" and got["2"]["emp_name"] == "Unknown_User"
    assert got["2"]["risk_score"] == 55.5 and got["2"]["bytes_total"] == 0.0 and got["2"]["duration"] == 3.0
    assert got["1"]["risk_score"] == 10.0 and got["1"]["bytes_total"] is None


def test_policy_last_depends_on_the_columns_of_the_batch(spark, place):
    """As in the original: a column that no row fills does not count, one that a row fills does."""
    write, spec, store, _ = place
    spec = replace(spec, mapping_policy="last")
    write("a.log", "2026-01-01 00:00:01 | E1 | login | 10.0.0.1 | password")
    run_source(spark, store, spec, seq=1)
    first = store.alerts.alerts().first()
    assert (first["user_id"], first["src_ip"], first["user"]) == ("E1", "10.0.0.1", "Unknown_User")
    write("a.log", "2026-01-01 00:00:02 | E1 | login | 10.0.0.1 | password",
          json.dumps({"timestamp": "2026-01-01 00:00:03", "user_id": "E2", "user": "Lee", "action": "x"}))
    run_source(spark, store, spec, seq=2)
    got = sorted((r["timestamp"][-2:], r["user_id"], r["src_ip"]) for r in store.alerts.alerts().collect())
    assert got == [("01", "E1", "10.0.0.1"), ("02", "Unknown_ID", "10.0.0.1"), ("03", "Lee", "Internal")]


def test_policy_last_evaluates_each_row_once(spark, place):
    write, spec, store, _ = place
    write("a.log", *[line(s) for s in range(1, 11)])
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    raw = spark.read.text(spec.path).mapInArrow(counted, "value string")
    assert load_batch(store, replace(spec, mapping_policy="last"), raw, 1) == 10
    assert seen.value == 10


def test_table_rows_take_their_own_cursor(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path / "s"))
    spec = SourceSpec(name="hr", type="postgres", database="d", table_name="t", watermark_col="emp_no", watermark_default="0")
    raw = rows([(9, "a", None), (10, "b", 2.5)], "emp_no int, user string, risk_score double")
    assert store.cursor(spec) == "0"
    load_batch(store, spec, raw, 1)
    assert store.cursor(spec) == "10"
    row = store.cursors("hr").read().first()
    assert (row["source_name"], row["watermark_type"]) == ("hr", "int")


def test_lines_are_parsed_once(spark, place):
    write, spec, _, _ = place
    write("a.log", line(1))
    df = scored_events(spark.read.text(spec.path), spec, last="2026-01-01 00:00:00")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(ArrayType") == 1
    assert "Python" not in plan


def test_learning(spark, place, tmp_path):
    write, _, store, _ = place
    folder = f"{tmp_path}/logs"
    write("authentication_a.log", '{"user":"Kim","ip":"1","x":1}', '{"department":"HR"}')
    write("firewall.log", "not json", '{"src_ip":"1"}')
    write("unrelated.log", '{"user":"Kim"}')
    learn(spark, store, folder, version=1)
    assert registered_rules(store, "Auth_Logs") == [("user_id", "user"), ("src_ip", "ip"), ("emp_name", "mapped_name")]
    assert registered_rules(store, "Firewall_Logs") == []
    learn(spark, store, folder, version=2, whole_files=True)
    assert registered_rules(store, "Firewall_Logs") == [("src_ip", "src_ip")]
    assert registered_rules(store, "Auth_Logs")[:2] == [("department", "department"), ("user_id", "user")]
    assert learned_rules(spark, folder).count() == 3
    spec = SourceSpec(name="Auth_Logs", type="file", path=f"{folder}/authentication_a.log")
    assert sorted(r["key"] for r in discover_columns(spark, spec).collect()) == ["department", "ip", "user", "x"]


def test_a_cycle_uses_what_it_learned_and_names_people(spark, place, tmp_path, rows):
    write, spec, store, _ = place
    write("authentication_a.log", line(1, user="7"), json.dumps({"timestamp": "2026-01-01 00:00:02", "user": "8", "ip": "10.1.1.1"}))
    register_reader("staff", lambda spark, spec, at: rows([("7", "Kim"), ("8", "Lee")], "Emp_ID string, Emp_Name string"))
    people = SourceSpec(name="HR", type="staff", people=True, table_name="t", watermark_col="emp_id", watermark_default="0")
    try:
        run_all(spark, store, [people, spec], learn_from=f"{tmp_path}/logs")
    finally:
        READERS.pop("staff")
    assert ("user_id", "user_id") in registered_rules(store, "Auth_Logs")
    named = {r["timestamp"][-2:]: (r["user_id"], r["emp_name"]) for r in store.alerts.alerts().filter("log_source = 'Auth_Logs'").collect()}
    assert named["01"] == ("7", "Kim")
    # without its source of names a cycle still loads
    write("authentication_b.log", line(9))
    assert run_all(spark, store, [people, spec]) == 1


# streams


def run_stream(spark, place, **options):
    _, spec, store, checkpoint = place
    query = start_loading(source_stream(spark, spec), store, spec, checkpoint, once=True, **options)
    query.awaitTermination()


def test_stream_loads_new_files_only(spark, place):
    write, spec, store, _ = place
    write("a.log", line(1), line(2))
    run_stream(spark, place)
    assert loaded(store) == [("01", "login"), ("02", "login")]
    write("b.log", line(2), line(3, action="next"))
    run_stream(spark, place)
    assert loaded(store) == [("01", "login"), ("02", "login"), ("03", "next")]
    # no row of the stream is late against the stream itself
    assert {r["id"]: r["processed_count"] for r in store.history().collect()} == {"Auth_Logs-0": 2, "Auth_Logs-1": 2}
    assert store.cursor(spec) == "2026-01-01 00:00:03"


@pytest.mark.parametrize("limits", [{}, {"max_files": 1}, {"max_files": 2}, {"max_bytes": 1}])
def test_how_a_backlog_is_cut_does_not_decide_what_is_kept(spark, place, limits):
    write, spec, store, checkpoint = place
    write("z.log", line(1))
    run_source(spark, store, spec, seq=1)
    for host in range(3):
        write(f"h{host}.log", *[line(s, user=f"H{host}") for s in range(0, 40, 7)])
    query = start_loading(source_stream(spark, spec, **limits), store, spec, checkpoint, once=True, first_seq=10)
    query.awaitTermination()
    got = store.alerts.alerts().filter("user_id LIKE 'H%'")
    assert got.count() == 3 * 5  # second 0 is late against the cursor the stream began with
    late = {r["late"] for r in store.history().filter("start_time IS NOT NULL AND id <> 'Auth_Logs-1'").selectExpr("sum(late_count) AS late").collect()}
    assert late == {3 + 1}
    # a restart with new files sees the same cutoff
    write("h9.log", line(2, user="H9"))
    start_loading(source_stream(spark, spec, **limits), store, spec, checkpoint, once=True, first_seq=10).awaitTermination()
    assert store.alerts.alerts().filter("user_id = 'H9'").count() == 1


@pytest.mark.parametrize("split", ["128m", "300b"])
def test_equal_lines_without_a_time_stay_apart_in_a_stream(spark, place, tmp_path, split):
    write, spec, store, checkpoint = place
    fire = replace(spec, name="Firewall_Logs")
    text = "[allow] src=10.0.0.1 dst=10.0.0.2 dst_port=443 proto=TCP service=Jira bytes=512"
    write("a.log", *[text] * 50)
    write("b.log", *[text] * 7)
    ids = []
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        for name, limits in (("one", {}), ("each", {"max_files": 1})):
            other = Store(spark, f"{tmp_path}/{name}")
            start_all(spark, other, [fire], f"{checkpoint}-{name}", limits=limits, once=True)[fire.name].awaitTermination()
            assert sum(r["processed_count"] for r in other.history().collect()) == 57
            ids.append(sorted(r["row_id"] for r in other.alerts.alerts().collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(set(ids[0])) == 57
    assert ids[0] == ids[1]  # how the files are cut into batches does not name the lines


@pytest.mark.parametrize("step", ["save_cursor", "save_run"])
def test_a_repeated_batch_takes_effect_once(spark, place, monkeypatch, step):
    """The stream dies after the load, before or after the cursor moved, and is restarted."""
    write, spec, store, _ = place
    write("a.log", line(1), line(2))
    with monkeypatch.context() as patched:
        def die(self, *args, **kwargs):
            raise RuntimeError("lost")

        patched.setattr(Store, step, die)
        with pytest.raises(Exception):
            run_stream(spark, place)
    assert store.alerts.rows().count() == 2
    run_stream(spark, place)
    assert loaded(store) == [("01", "login"), ("02", "login")]
    assert store.alerts.rows().count() == 2
    assert store.cursor(spec) == "2026-01-01 00:00:02"
    status = sorted((r["status"], r["processed_count"]) for r in store.history().collect())
    assert status == [("FAIL", 0), ("SUCCESS", 2)]


def test_sources_stream_side_by_side(spark, place, tmp_path):
    write, spec, store, checkpoint = place
    (tmp_path / "web").mkdir()
    (tmp_path / "web" / "w.log").write_text("2026-01-01 00:00:09 | 10.0.0.1 | GET / | 200 | agent\n")
    write("a.log", line(1))
    web = SourceSpec(name="Web_Logs", type="file", path=f"{tmp_path}/web")

    def broken(df):
        raise ValueError("no such stage")

    queries = start_all(spark, store, [spec, web], checkpoint, once=True, stages=[broken])
    for query in queries.values():
        query.awaitTermination()
    assert {r["log_source"] for r in store.alerts.alerts().collect()} == {"Auth_Logs", "Web_Logs"}
    with pytest.raises(ValueError):
        source_stream(spark, SourceSpec(type="postgres"))


def test_a_failed_stream_is_started_again_in_the_next_cycle(spark, place, tmp_path):
    write, spec, store, checkpoint = place
    write("a.log", line(1))

    def fail(batches):
        raise RuntimeError("no model")
        yield

    def broken(df):
        return df.mapInPandas(fail, df.schema)

    queries = start_all(spark, store, [spec], checkpoint, once=True, stages=[broken])
    with pytest.raises(Exception):
        queries["Auth_Logs"].awaitTermination()
    again = start_all(spark, store, [spec], checkpoint, once=True, running=queries)
    again["Auth_Logs"].awaitTermination()
    assert again["Auth_Logs"] is not queries["Auth_Logs"]
    assert loaded(store) == [("01", "login")]


def test_a_topic_is_read_on_from_its_offsets(spark, place, monkeypatch):
    """The topic is played by a folder: a stream with its own checkpoint, as the connector's."""
    write, spec, store, _ = place
    topic = replace(spec, type="kafka")
    monkeypatch.setattr(streaming, "source_stream", lambda spark, s, **limits: source_stream(spark, spec))
    write("a.log", line(1), line(2))
    assert run_source(spark, store, topic) == 2
    write("b.log", line(3))
    assert run_source(spark, store, topic) == 1
    assert run_source(spark, store, topic) == 0
    assert len(loaded(store)) == 3
