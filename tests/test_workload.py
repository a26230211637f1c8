"""Every registered query against its SQL on the smallest tables."""

import glob
import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from logweir import workload
from logweir.sources.files import present_files
from logweir.workload import stores
from logweir.workload.tables import SOURCE_OF_TYPE, json_lines

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = workload.all_queries(), workload.all_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(v, 6) if isinstance(v, float) else str(v)


def _rows(frame):
    names = sorted(frame.columns)
    return sorted(repr([_value(v) for v in r]) for r in frame[names].astype(object).values.tolist())


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    want = db.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"model_slot"}))
def test_plans_stay_in_the_jvm(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_filters_reach_the_scan(spark):
    for name, column in [("cursor_filter", "ts"), ("scan_after_id", "c_name"), ("scan_custom_query", "o_orderdate")]:
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"PushedFilters: \[[^\]]*GreaterThan\({column}", plan), name


def test_only_asked_columns_are_read(spark):
    plan = QUERIES["score_by_rules"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_sources_of_a_cycle_are_written_in_parallel(spark, monkeypatch):
    files = {}
    monkeypatch.setattr(stores, "json_lines", lambda s, folder: json_lines(s, folder).repartition(4))
    monkeypatch.setattr(stores, "run_all", lambda s, store, specs: files.update(
        {x.name: present_files(s, x).count() for x in specs if x.kind == "file"}
    ))
    stores.cycle_with_learned_rules(spark, FOLDER)
    assert set(files) == set(SOURCE_OF_TYPE.values()) and min(files.values()) > 1
