import math
import random

import pytest
from pyspark.sql import Row, functions as F

from logweir.constants import EPOCH_TEXT, MAPPING_RULES
from logweir.functions.fingerprint import with_row_id
from logweir.operators.columns import (
    classify_name,
    complete_required,
    drop_all_null_columns,
    event_times,
    fill_defaults,
    nan_to_null,
    non_null_counts,
    standard_event,
)
from logweir.operators.cursor import after_cursor, batch_metrics
from logweir.operators.detect import score_model, score_rule_table, score_rules, to_notify
from logweir.operators.enrich import (
    add_mapped_name,
    add_person_name,
    enrich,
    person_lookup,
    valid_departments,
    with_department,
)
from logweir.operators.keyed import (
    alert_document,
    conform,
    insert_unique,
    latest_per_key,
    load_counts,
    upsert,
    with_load_error,
)
from logweir.operators.mapping import (
    apply_rules,
    apply_rules_by_source,
    first_source,
    infer_rules,
    rules_as_xml,
    source_of,
)
from logweir.operators.ordinal import assign_assets, with_ordinal
from logweir.operators.parse import parse_lines
from logweir.operators.totals import latest_runs, run_report, source_totals, union_all
from logweir.plans.events import prepared_lookup
from logweir.plans.stages import run_stages
from logweir.schemas import PERSONAL_COLUMNS, alert_table
from logweir.sources.rules import rules_from_xml

from conftest import as_dicts


# columns


def test_all_null_columns_go(rows):
    df = rows([(1, None, "a"), (2, None, None)], "a int, b string, c string")
    assert non_null_counts(df).first() == Row(a=2, b=0, c=1)
    assert drop_all_null_columns(df).columns == ["a", "c"]


def test_nan_becomes_null(rows):
    df = rows([(math.nan, 1.0, "NaN"), (None, math.nan, None)], "a double, b float, c string")
    got = [tuple(r) for r in nan_to_null(df).collect()]
    assert got == [(None, 1.0, "NaN"), (None, None, None)]


def test_standard_event_fills_and_tags(rows):
    df = rows([(None, 7, "2026-02-19 17:36:30.5", "old")], "user string, user_id int, timestamp string, log_source string")
    got = as_dicts(standard_event(df, "Auth_Logs"))[0]
    assert got["user"] == "Unknown_User" and got["user_id"] == "7"
    assert got["department"] == "Unknown_Dept" and got["src_ip"] == "Internal"
    assert got["action"] == "Unknown_Action" and got["log_source"] == "Auth_Logs"
    assert got["timestamp"] == "2026-02-19 17:36:30"
    assert str(got["final_ts"]) == "2026-02-19 17:36:30.500000" and not got["time_inferred"]


def test_event_time_order_and_ingest_time(rows):
    df = rows(
        [
            ("2026-01-01 00:00:01", "2026-01-02 00:00:00"),
            (None, "2026-01-02T00:00:00+09:00"),
            ("broken", "2026-01-03 00:00:00"),
            (None, None),
        ],
        "final_ts string, timestamp string",
    )
    got = event_times(df, F.lit("2030-05-05 05:05:05")).orderBy("final_ts")
    assert [(r["timestamp"], r["time_inferred"]) for r in got.collect()] == [
        ("2026-01-01 00:00:01", False),
        ("2026-01-02 00:00:00", False),
        ("2026-01-03 00:00:00", False),
        ("2030-05-05 05:05:05", True),
    ]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Seoul", "UTC"])
def test_times_do_not_depend_on_the_session_zone(spark, rows, zone):
    """02:30 does not exist in New York that day, but it does in the log."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = event_times(rows([("2026-03-08 02:30:00",)], "final_ts string"))
        doc = alert_document(df).first()
        assert doc["timestamp"] == "2026-03-08 02:30:00"
        assert doc["final_ts"] == "2026-03-08T02:30:00+09:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_required_columns_and_volatile_names(rows):
    df = complete_required(rows([(1, "x")], "row_id int, user string"))
    assert df.columns == ["row_id", "user", "user_id", "department", "action", "src_ip", "log_source"]
    assert fill_defaults(df).first()["user"] == "x"


def test_first_name_part_wins(rows):
    df = rows([("webserver_authentication.log",), ("endpoint.log",), ("x.log",)], "n string")
    got = [r[0] for r in df.select(classify_name("n")).collect()]
    assert got == ["Auth_Logs", "Endpoint_Logs", "Unknown"]


# mapping


def _sequential(row, rules, policy):
    """Rules applied one target after the other on one row."""
    row, listed = dict(row), {}
    for target, source in rules:
        listed.setdefault(target, []).append(source)
    for target, sources in listed.items():
        sources = [s for s in sources if s in row]
        if policy == "last":
            if listed[target][-1] in row:
                row[target] = row[listed[target][-1]]
            continue
        if policy == "last_present":
            sources.reverse()
        if sources:
            given = [row[s] for s in sources] + [row.get(target)]
            row[target] = next((v for v in given if v is not None), None)
    return row


@pytest.mark.parametrize("policy", ["last", "last_present", "first_present"])
def test_mapping_policies(rows, policy):
    data = [
        (None, "Kim", "HR", None, "1.1.1.1"),
        ("E1", None, None, "9.9.9.9", None),
        ("E2", "Lee", "IT", "8.8.8.8", "2.2.2.2"),
    ]
    names = ["user_id", "user", "department", "src_ip", "ip"]
    chained = [("a", "user"), ("b", "a"), ("a", "ip"), ("user", "b"), ("gone", "nothing")]
    for rules in (MAPPING_RULES["Auth_Logs"], chained):
        df = apply_rules(rows(data, ", ".join(f"{n} string" for n in names)), rules, policy)
        want = [_sequential(dict(zip(names, r)), rules, policy) for r in data]
        assert as_dicts(df) == want


def test_mapping_mixes_types_as_text(rows):
    df = apply_rules(rows([(7, None)], "user_id int, user string"), MAPPING_RULES["Auth_Logs"])
    assert df.first()["user_id"] == "7"
    with pytest.raises(ValueError):
        apply_rules(df, [], "other")


def test_rules_as_data_equal_rules_in_the_plan(spark):
    lines = [
        ("Auth_Logs", '{"user":"Kim","user_id":"E1","ip":"1.1.1.1"}'),
        ("Web_Logs", '{"user_id":"E2","resource":"/x"}'),
        ("Other", '{"user":"Q"}'),
    ]
    df = parse_lines(spark.createDataFrame(lines, "log_source string, value string"))
    rules = spark.createDataFrame(
        [(s, i, t, f) for s, p in MAPPING_RULES.items() for i, (t, f) in enumerate(p)],
        "log_source string, pos int, target string, source string",
    )
    got = {r["log_source"]: r["mapped"] for r in apply_rules_by_source(df, rules).collect()}
    assert got == {
        "Auth_Logs": {"user_id": "Kim", "src_ip": "1.1.1.1"},
        "Web_Logs": {"user_id": "E2", "resource": "/x"},
        "Other": {},
    }


def test_learned_rules_and_their_documents(spark):
    lines = [
        ("Auth_Logs", '{"timestamp":"t","user_id":"E1","user":"Kim","ip":"1"}'),
        ("Auth_Logs", '{"ip":"2","department":"HR"}'),
        ("Device", '{"device_id":"d","x":1}'),
    ]
    df = parse_lines(spark.createDataFrame(lines, "log_source string, value string"))
    rules = infer_rules(df)
    got = [tuple(r) for r in rules.orderBy("log_source", "pos").collect()]
    assert got == [
        ("Auth_Logs", 0, "src_ip", "ip"),
        ("Auth_Logs", 1, "department", "department"),
        ("Auth_Logs", 2, "user_id", "user_id"),
        ("Auth_Logs", 3, "user_id", "user"),
        ("Auth_Logs", 4, "emp_name", "mapped_name"),
        ("Device", 0, "device_id", "device_id"),
    ]
    back = rules_from_xml(rules_as_xml(rules))
    assert sorted(map(tuple, back.collect())) == sorted(got)
    first = {(r["log_source"], r["target"]): r["source"] for r in first_source(back).collect()}
    assert first[("Auth_Logs", "user_id")] == "user_id"
    assert source_of(MAPPING_RULES["Auth_Logs"], "src_ip") == "ip"
    assert source_of([], "src_ip") == "src_ip"


# employees


PEOPLE = [(1, "E1", "Old"), (3, "E1", "New"), (2, "E2", None), (4, None, "Nobody")]


def test_lookup_roles_and_last_row(rows):
    people = rows(PEOPLE, "pos int, `EMP_ID ` string, ` Name_KR` string")
    got = {r["person_id"]: r["person_name"] for r in person_lookup(people, "pos").collect()}
    assert got == {"E1": "New", "E2": None}
    by_place = rows([(5, "Kim")], "a int, b string")
    assert as_dicts(person_lookup(by_place)) == [{"person_id": "5", "person_name": "Kim"}]


@pytest.mark.parametrize("bound", ["10m", "-1"])
def test_names_with_and_without_broadcast(spark, rows, tmp_path, bound):
    """A hot key, misses and nulls give the same rows on both join ways; Spark picks by size."""
    people = rows([("1", "Kim"), ("2", "Lee")], "emp_id string, emp_name string")
    lookup = prepared_lookup(people, f"{tmp_path}/people")
    data = [(i, 1 if i % 3 else i % 4) for i in range(60)] + [(99, None)]
    events = rows(data, "i int, user_id int")
    named = add_person_name(events, lookup)
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    try:
        plan = named._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (bound != "-1")
        got = {r["i"]: r["emp_name"] for r in named.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
    names = {1: "Kim", 2: "Lee"}
    assert got == {i: names.get(u, "Unknown_User") for i, u in data}


def test_mapped_name_fills_only_nulls(rows):
    lookup = person_lookup(rows([("1", "Kim")], "emp_id string, emp_name string"))
    rules = [("user_id", "account"), ("emp_name", "who")]
    events = rows([("1", None), ("1", "Own"), ("7", None)], "account string, who string")
    got = sorted(r["who"] for r in add_mapped_name(events, lookup, rules).collect())
    assert got == ["Kim", "Own", "Unknown_User"]
    created = add_mapped_name(events.drop("who"), lookup, rules).collect()
    assert sorted(r["who"] for r in created) == ["Kim", "Kim", "Unknown_User"]
    assert add_mapped_name(events.drop("account"), lookup, rules).columns == ["who"]
    assert add_person_name(events, lookup).columns == ["account", "who"]


def test_one_join_serves_both_names(rows):
    lookup = person_lookup(rows([("1", "Kim")], "emp_id string, emp_name string"))
    events = rows([("1", None), ("2", "Own")], "user_id string, mapped_name string")
    rules = MAPPING_RULES["Auth_Logs"]
    one = enrich(events, lookup, rules)
    two = add_mapped_name(add_person_name(events, lookup), lookup, rules)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert one._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    assert enrich(events, None, rules) is events


def test_department_join(rows):
    staff = rows([("E1", "Kim", 1), ("E2", "Lee", 9), ("E3", None, 1), (None, "X", 1)],
                 "employee_id string, name_kr string, department_id int")
    depts = rows([(1, "HR")], "department_id int, department_name string")
    got = sorted(tuple(r) for r in with_department(staff, depts).collect())
    assert got == [("E1", "Kim", "HR"), ("E2", "Lee", "Unknown")]


def test_valid_departments(rows):
    people = rows([("E1", "HR", "1"), ("E2", "", "2"), ("E3", "Unknown_Dept", "3"), (None, "HR", "4"), ("E5", None, "5")],
                  "emp_id string, dept_name string, static_ip string")
    assert as_dicts(valid_departments(people)) == [{"user_id": "E1", "department": "HR", "src_ip": "1"}]


def test_ordinal_is_a_dense_order(spark):
    """Numbers follow the order and stay dense with a key held by a third of the rows."""
    random.seed(3)
    keys = [random.choice(["hot", f"k{i:04d}", f"k{i % 50:04d}"]) for i in range(900)]
    df = with_ordinal(spark.createDataFrame([(k,) for k in keys], "k string"), ["k"])
    got = sorted((r["ordinal"], r["k"]) for r in df.collect())
    assert [o for o, _ in got] == list(range(900))
    assert [k for _, k in got] == sorted(keys)


def test_assets(rows):
    staff = rows([(f"E{i:03d}", f"n{i}", "HR") for i in range(260)], "emp_id string, user_name string, dept_name string")
    got = {r["user_id"]: (r["ip"], r["device_id"]) for r in assign_assets(staff).collect()}
    assert got == {
        f"E{i:03d}": (f"192.168.{i % 20 + 10}.{i % 250 + 1}", f"WS-E{i:03d}") for i in range(260)
    }


# detection


def test_scores_and_messages(rows):
    df = rows([("Reverse_Shell_C2",), ("SSH_BruteForce",), ("login",)], "action string")
    got = {r["action"]: (r["risk_score"], r["alert_message"][:4]) for r in score_rules(df).collect()}
    assert got["Reverse_Shell_C2"][0] == 99.0 and got["SSH_BruteForce"][0] == 85.0
    assert got["login"] == (10.0, "Info")
    kept = score_rules(df.withColumns({"risk_score": F.lit(42.0), "alert_message": F.lit("m")}))
    assert kept.filter("action = 'login'").first()["risk_score"] == 42.0
    assert [r["action"] for r in to_notify(score_rules(df)).collect()] == ["Reverse_Shell_C2"]


def test_rule_table_equals_rule_chain(spark, rows):
    from logweir.constants import DETECTION_RULES

    table = spark.createDataFrame(DETECTION_RULES, "match_value string, risk_score double, alert_message string")
    df = rows([(v,) for v, _, _ in DETECTION_RULES] + [("x",), (None,)], "action string")
    assert sorted(map(str, score_rule_table(df, table).collect())) == sorted(map(str, score_rules(df).collect()))


def test_stages_skip_what_cannot_be_planned(rows):
    df = rows([("login",)], "action string")
    out = run_stages(df, [lambda d: d.select("nope"), score_rules, lambda d: 1 / 0, score_model])
    assert out.first()["risk_score"] == 10.0


def test_fingerprint(rows):
    base = rows([("Login ", "2026-01-01 00:00:00", None, 8.5e9, "secret")],
                "action string, final_ts string, user string, bytes double, ssn string")
    base = base.withColumn("final_ts", F.col("final_ts").cast("timestamp_ntz"))
    import hashlib

    text = "login|8500000000.000000|2026-01-01 00:00:00|null"
    want = hashlib.md5(text.encode()).hexdigest()
    assert with_row_id(base).first()["row_id"] == want
    shuffled = base.select("user", "ssn", "final_ts", "bytes", "action").withColumn("row_id", F.lit("x"))
    assert with_row_id(shuffled).first()["row_id"] == want
    later = base.withColumns({"time_inferred": F.lit(True)})
    other = later.withColumn("final_ts", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))
    assert with_row_id(later).first()["row_id"] == with_row_id(other).first()["row_id"]


# cursors


def test_cursor_is_strict_and_typed(rows):
    df = rows([(1, "10"), (2, "9"), (None, None)], "n int, s string")
    assert [r["n"] for r in after_cursor(df, "n", "1").collect()] == [2]
    assert [r["s"] for r in after_cursor(df, "s", "10").collect()] == ["9"]
    assert after_cursor(df, "n", EPOCH_TEXT).count() == 3
    with pytest.raises(ValueError, match="is no int"):
        after_cursor(df, "n", "EMP001")
    assert batch_metrics(df, "n").first() == Row(row_count=3, watermark_value="2")


# keyed rows


def test_upsert_is_idempotent(rows):
    target = rows([("a", 1, "x"), ("b", 1, "y")], "k string, version int, v string")
    batch = rows([("b", 2, "z"), ("c", 2, "w")], "k string, version int, v string")
    once = upsert(target, batch, ["k"], "version")
    twice = upsert(once, batch, ["k"], "version")
    want = {("a", 1, "x"), ("b", 2, "z"), ("c", 2, "w")}
    assert set(map(tuple, once.collect())) == set(map(tuple, twice.collect())) == want


def test_hot_key_is_cut_before_the_shuffle(rows):
    df = rows([("hot", i) for i in range(100)] + [("b", 1)], "k string, n int")
    latest = latest_per_key(df, ["k"], [F.col("n").desc()])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2
    assert set(map(tuple, latest.collect())) == {("hot", 99), ("b", 1)}


def test_unique_key_keeps_first_and_lets_nulls_pass(rows):
    random.seed(5)
    data = [(i, random.choice(["a", "b", None]), random.choice(["x", "y", None])) for i in range(80)]
    stored = [(900, "a", "x"), (901, None, "y")]
    schema = "i int, k string, l string"
    got = insert_unique(rows(data, schema), [F.col("i")], rows(stored, schema), ["k", "l"])
    seen, want = {("a", "x")}, []
    for i, k, l in data:
        if k is None or l is None:
            want.append(i)
        elif (k, l) not in seen:
            seen.add((k, l))
            want.append(i)
    assert sorted(r["i"] for r in got.collect()) == want


def test_conform_is_typed_and_hides_personal_data(rows):
    df = rows([("2026-01-01 00:00:00", "x", "12", "ssn")], "final_ts string, bytes_total string, src_port string, ssn string")
    got = as_dicts(conform(df, alert_table()))[0]
    assert got["bytes_total"] is None and got["src_port"] == 12 and got["created_at"] is not None
    assert not set(PERSONAL_COLUMNS) & set(got)
    assert conform(df, alert_table(personal=True)).first()["ssn"] == "ssn"
    assert len(alert_table(personal=True)) == 31


def test_documents_and_errors(rows):
    df = rows([("2026-01-01 10:00:00.25", "x", None), ("bad", "3", "4.5")], "final_ts string, duration string, risk_score string")
    marked = with_load_error(df, {"duration": "double", "final_ts": "timestamp_ntz"})
    assert [r["error_reason"] for r in marked.collect()] == ["duration: not a double: x", "final_ts: not a timestamp_ntz: bad"]
    assert load_counts(marked).first() == Row(loaded=0, failed=2)
    doc = alert_document(df.filter("final_ts <> 'bad'")).first()
    assert doc == Row(final_ts="2026-01-01T10:00:00+09:00", duration=0.0, risk_score=0.0)


# totals and reports


def test_union_and_totals(rows):
    a, b = rows([("x", 1)], "log_source string, n int"), rows([("y", "q")], "log_source string, m string")
    both = union_all([a, b])
    assert set(map(tuple, both.collect())) == {("x", 1, None), ("y", None, "q")}
    assert set(map(tuple, source_totals(both).collect())) == {("x", 1), ("y", 1), (None, 2)}


def test_report(spark):
    data = [(f"{i:03d}", f"2026-01-01 00:{i:02d}:00", "s", "alerts", i * 1000, "SUCCESS" if i % 2 else "FAIL") for i in range(40)]
    history = spark.createDataFrame(data, "id string, collect_time string, source_name string, target_index string, processed_count long, status string")
    assert [r["id"] for r in latest_runs(history).collect()] == [f"{i:03d}" for i in range(39, 9, -1)]
    top = run_report(history).first()
    assert top["processed"] == "39,000 건" and top["status_label"] == "✅ 성공"
    assert "TakeOrderedAndProject" in latest_runs(history)._jdf.queryExecution().executedPlan().toString()
