"""Clearing, the behaviour model, and what a running stream takes from the store."""

import datetime as dt

from pyspark.sql import functions as F

from logweir.operators.behaviour import behaviour_scores, day_profiles, merged_profiles, score_behaviour
from logweir.plans.ingest import run_all, run_source
from logweir.plans.store import Store
from logweir.sources.spec import SourceSpec

SHAPE = "user_id string, event_date date, action string, bytes_total double"


def _events(rows, data):
    return rows([(u, dt.date(2026, 1, d), a, b) for u, d, a, b in data], SHAPE)


def test_days_are_compared_with_the_days_before(spark, rows):
    quiet = [("a", d, "login", float(d)) for d in range(1, 9)]
    odd = [("a", 9, "dump", 100.0), ("a", 9, "login", None), (None, 9, "login", 1.0), ("b", 9, "login", float("nan"))]
    events = _events(rows, quiet + odd)
    parts = [day_profiles(events.filter(F.col("action") == a)) for a in ("login", "dump")]
    got = {(r["user_id"], r["event_date"].day): r for r in behaviour_scores(merged_profiles(parts[0].unionByName(parts[1]))).collect()}
    assert len(got) == 10
    first, ninth, other = got["a", 1], got["a", 9], got["b", 9]
    assert first["behaviour_score"] is None and first["base_n"] == 0
    assert (ninth["n"], ninth["n_kinds"], ninth["new_kinds"], ninth["amount_rank"]) == (2, 2, 1, 1.0)
    assert ninth["behaviour_score"] == 75.0
    assert other["amount_rank"] is None and other["behaviour_score"] is None
    scored = score_behaviour(events, behaviour_scores(merged_profiles(day_profiles(events))), threshold=75.0)
    assert scored.count() == events.count()
    raised = scored.filter("risk_score = 75").select("user_id", "action").collect()
    assert sorted(tuple(r) for r in raised) == [("a", "dump"), ("a", "login")]


def test_days_beyond_the_window_do_not_count(spark, rows):
    events = _events(rows, [("a", 1, "x", 1.0), ("a", 20, "x", 1.0)])
    last = behaviour_scores(day_profiles(events), days=14).filter("event_date = DATE '2026-01-20'").first()
    assert last["base_n"] == 0 and last["behaviour_score"] is None


def test_sketches_stay_near_the_exact_counts(spark):
    """Beyond what sketches hold exactly: 40,000 kinds and amounts."""
    events = spark.range(40_000).select(
        F.lit("u").alias("user_id"), F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 2).cast("int")).alias("event_date"),
        F.col("id").cast("string").alias("action"), F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.lit(20_000)).cast("double").alias("bytes_total"),
    )
    row = behaviour_scores(day_profiles(events)).filter("base_n > 0").first()
    assert abs(row["new_kinds"] - 20_000) < 2 * 0.03 * 40_000
    assert abs(row["amount_rank"] - 0.5) < 0.03


def test_no_events_no_scores(spark, rows):
    assert behaviour_scores(merged_profiles(day_profiles(_events(rows, [])))).isEmpty()


def test_the_model_stays_in_the_jvm(spark, rows):
    events = _events(rows, [("a", 1, "x", 1.0)])
    plan = score_behaviour(events, behaviour_scores(day_profiles(events)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def _line(second, user="E1"):
    return f'{{"timestamp":"2026-01-01 00:00:{second:02}","user_id":"{user}","action":"login","bytes_total":{second}}}\n'


def _spec(tmp_path, name="Auth_Logs", **more):
    (tmp_path / name).mkdir(exist_ok=True)
    return SourceSpec(name=name, type="file", path=f"{tmp_path}/{name}", late_policy="allow", **more)


def test_a_repeated_load_replaces_its_profiles(spark, tmp_path):
    store, spec = Store(spark, f"{tmp_path}/store"), _spec(tmp_path)
    (tmp_path / "Auth_Logs" / "a.log").write_text(_line(1) + _line(2))
    for _ in range(2):
        run_source(spark, store, spec, seq=1, profile=True)
    (row,) = store.behaviour().collect()
    assert (row["user_id"], row["n"]) == ("E1", 2)


def test_a_cleared_index_stays_cleared(spark, tmp_path):
    store, spec = Store(spark, f"{tmp_path}/store"), _spec(tmp_path)
    logs = tmp_path / "Auth_Logs"
    (logs / "a.log").write_text(_line(1))
    run_source(spark, store, spec, seq=1)
    store.alerts.merge(keep=0)
    store.alerts.clear()
    assert store.alerts.alerts().isEmpty()
    (logs / "b.log").write_text(_line(2))
    run_source(spark, store, spec, seq=2)
    store.alerts.merge(keep=0)
    store.alerts.drop_merged()
    assert [r["bytes_total"] for r in store.alerts.alerts().collect()] == [2.0]
    store.alerts.clear()
    store.alerts.clear()
    assert store.alerts.alerts().isEmpty() and store.history().count() == 2


def test_sources_run_side_by_side(spark, tmp_path):
    """More sources than run at once, one of them broken: each has its own rows and run."""
    store = Store(spark, f"{tmp_path}/store")
    specs = [_spec(tmp_path, f"s{n}") for n in range(4)]
    for n, spec in enumerate(specs):
        (tmp_path / spec.name / "a.log").write_text("".join(_line(s, f"U{n}") for s in range(1, n + 2)))
    broken = SourceSpec(name="broken", type="no_such_type")
    assert run_all(spark, store, [*specs[:2], broken, *specs[2:]], at_once=3) == 10
    runs = {r["source_name"]: (r["status"], r["processed_count"]) for r in store.history().collect()}
    assert runs == {"broken": ("FAIL", 0), **{f"s{n}": ("SUCCESS", n + 1) for n in range(4)}}
    users = store.alerts.alerts().groupBy("log_source", "user_id").count().collect()
    assert sorted((r["log_source"], r["user_id"], r["count"]) for r in users) == [(f"s{n}", f"U{n}", n + 1) for n in range(4)]
    assert run_all(spark, store, specs, at_once=1) == 0


def test_a_repeat_has_the_sides_of_its_first_try(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/store")
    store.save_people("/one", 1)
    assert store.sides("s", 0, lambda: [("a", "b")]) == ("/one", [("a", "b")])
    store.save_people("/two", 2)
    assert store.sides("s", 0, lambda: [("c", "d")]) == ("/one", [("a", "b")])
    assert store.sides("s", 1, lambda: None) == ("/two", None)
    store.save_people(None, 3)
    assert store.sides("s", 2, lambda: None) == (None, None)
