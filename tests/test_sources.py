import json
from dataclasses import replace

import pytest

from logweir.sources.database import (
    after_last,
    bind_cursor,
    bounds_options,
    jdbc_options,
    with_bounds,
)
from logweir.sources.files import log_path, present_files, read_lines
from logweir.sources.kafka import kafka_options
from logweir.sources.registry import Position, READERS, read_source, register_reader
from logweir.sources.rules import read_rules, rule_list, write_rules
from logweir.sources.spec import SourceSpec, load_specs, read_catalog


def test_catalog_takes_enabled_sources(spark, tmp_path):
    (tmp_path / "file_sources.json").write_text(
        json.dumps([
            {"name": "Auth_Logs", "type": "FILE", "path": "/x/*.log", "columns": ["port"]},
            {"name": "Off", "type": "file", "enabled": False},
        ])
    )
    (tmp_path / "db_sources.json").write_text(
        json.dumps([{"name": "hr", "type": "postgres", "port": 5432, "dbname": "d", "enabled": True,
                     "rules": [{"target": "a", "source": "b"}]}])
    )
    (tmp_path / "other.json").write_text("[]")
    assert read_catalog(spark, str(tmp_path)).count() == 2
    auth, hr = load_specs(spark, str(tmp_path))
    assert auth.kind == "file" and auth.columns == ("port",) and auth.line_pattern
    assert hr.database == "d" and hr.port == "5432" and hr.field_rules == [("a", "b")]


def test_file_lines(spark, tmp_path):
    (tmp_path / "a.log").write_text("one\ntwo\r\nthree\r", encoding="utf-8")
    (tmp_path / "b.log").write_text("four", encoding="utf-8")
    spec = SourceSpec(name="x", type="file", path=f"{tmp_path}/*.log")
    assert sorted(r[0] for r in read_lines(spark, spec).collect()) == ["four", "one", "three", "two"]
    assert len({r["place"] for r in read_lines(spark, spec).collect()}) == 4
    assert [r[0] for r in read_lines(spark, spec, [f"{tmp_path}/b.log"]).collect()] == ["four"]
    assert read_lines(spark, spec, []).isEmpty()
    assert present_files(spark, SourceSpec(path=f"{tmp_path}/none/*.log", type="file")).isEmpty()
    assert read_lines(spark, SourceSpec(path=f"{tmp_path}/none/*.log", type="file")).isEmpty()


def test_object_store_and_kafka_addresses():
    assert log_path(SourceSpec(type="s3", bucket="b", prefix="2026/")) == "s3a://b/2026/*"
    options = kafka_options(SourceSpec(type="kafka", brokers="h:9092", topic="t"), max_offsets=5)
    assert options["kafka.bootstrap.servers"] == "h:9092" and options["subscribe"] == "t"
    assert options["maxOffsetsPerTrigger"] == "5"


def test_jdbc_options(monkeypatch):
    spec = SourceSpec(name="hr-1", type="MariaDB", host="h", port="3306", database="d", table_name="t")
    monkeypatch.setenv("LOGWEIR_HR_1_USER", "u")
    monkeypatch.setenv("LOGWEIR_HR_1_PASSWORD", "p")
    got = jdbc_options(spec)
    assert got["url"] == "jdbc:mysql://h:3306/d" and got["dbtable"] == "t"
    assert (got["user"], got["password"]) == ("u", "p")
    split = SourceSpec(name="q", type="postgres", host="h", port="1", database="d",
                       query="SELECT * FROM t WHERE c > :last_updated", partition_col="id",
                       partition_lower="0", partition_upper="100", partition_count="8")
    got = jdbc_options(split, "E'1")
    assert got["dbtable"] == "(SELECT * FROM t WHERE c > 'E''1') q" and got["numPartitions"] == "8"
    plain = SourceSpec(name="q", type="postgresql", database="d", query="SELECT 1")
    assert jdbc_options(plain)["dbtable"] == "(SELECT 1) q" and "numPartitions" not in jdbc_options(plain)


def test_split_bounds():
    spec = SourceSpec(type="mysql", host="h", port="1", database="d", table_name="t", partition_col="id")
    options = bounds_options(spec)
    assert options["query"] == "SELECT min(id) AS low, max(id) AS high FROM t" and "dbtable" not in options
    given = SourceSpec(type="mysql", database="d", table_name="t", partition_col="id", partition_lower="1", partition_upper="9")
    assert with_bounds(None, given) is given
    assert jdbc_options(given)["numPartitions"] == "32"
    # the bounds are those of the rows that will be read
    marked = SourceSpec(type="mysql", host="h", port="1", database="d", table_name="t", watermark_col="n", partition_col="id")
    asked = lambda spec, last, kind=None: bounds_options(spec, last, kind)["query"]
    assert asked(marked, "7", "int") == "SELECT min(id) AS low, max(id) AS high FROM t WHERE n > 7"
    assert asked(replace(marked, partition_col=None), "2026-01-01", "timestamp_ntz") == (
        "SELECT min(n) AS low, max(n) AS high FROM t WHERE n > TIMESTAMP '2026-01-01'"
    )
    query = replace(marked, table_name=None, query="SELECT * FROM t WHERE n > :last_updated")
    assert asked(query, "7", "bigint") == "SELECT min(id) AS low, max(id) AS high FROM (SELECT * FROM t WHERE n > 7) q"


def test_a_saved_cursor_keeps_its_type():
    query = SourceSpec(type="mysql", database="d", query="SELECT * FROM t WHERE c > :last_updated")
    table = lambda last, kind: jdbc_options(query, last, kind)["dbtable"]
    assert table("12", "int").endswith("c > 12) q") and table("12", "string").endswith("c > '12') q")
    assert table("2026-01-01 00:00:00", "timestamp").endswith("c > TIMESTAMP '2026-01-01 00:00:00') q")
    assert table("12", None).endswith("c > 12) q") and table("1970-01-01 00:00:00", None).endswith("c > '1970-01-01 00:00:00') q")
    with pytest.raises(ValueError):
        table("1; DROP TABLE t", "bigint")


@pytest.mark.parametrize(
    "fields",
    [{"type": "oracle", "database": "d", "table_name": "t"}, {"type": "mysql", "table_name": "t"},
     {"type": "mysql", "database": "d"}],
)
def test_jdbc_needs_a_complete_spec(fields):
    with pytest.raises(ValueError):
        jdbc_options(SourceSpec(**fields))


def test_bound_cursor():
    query = "a > :last_updated"
    assert bind_cursor(query, "5", "number") == "a > 5"
    assert bind_cursor(query, "2026-01-01 00:00:00", "timestamp") == "a > TIMESTAMP '2026-01-01 00:00:00'"
    assert bind_cursor("no placeholder", "x") == "no placeholder"
    with pytest.raises(ValueError):
        bind_cursor(query, "1 OR 1=1", "number")


def test_table_cut_at_cursor(rows):
    df = rows([("E1",), ("E2",)], "emp_id string")
    spec = SourceSpec(type="mysql", table_name="t", watermark_col="emp_id")
    assert [r[0] for r in after_last(df, spec, "E1").collect()] == ["E2"]
    assert after_last(df, SourceSpec(type="mysql", query="q", watermark_col="emp_id"), "E1").count() == 2
    numbers = rows([(1,), (12,)], "n int")
    spec = SourceSpec(type="mysql", table_name="t", watermark_col="n")
    assert [r[0] for r in after_last(numbers, spec, "9").collect()] == [12]
    assert after_last(numbers, spec, "1970-01-01 00:00:00").count() == 2  # nothing read yet
    with pytest.raises(ValueError, match="is no int"):
        after_last(numbers, spec, "2026-01-01 00:00:00")


def test_rule_files(spark, tmp_path, rows):
    (tmp_path / "A.xml").write_text(
        '<?xml version="1.0" ?>\n<parser name="A">\n  <field target="u" source="x"/>\n'
        '  <field target="u" source="y"/>\n  <field target="" source="z"/>\n</parser>\n'
    )
    rules = read_rules(spark, str(tmp_path))
    assert rule_list(rules, "A") == [("u", "x"), ("u", "y")]
    assert read_rules(spark, f"{tmp_path}/none").isEmpty()
    out = f"{tmp_path}/written"
    document = '<parser name="{0}">\n  <field target="a" source="b"/>\n  <field target="c" source="{0}"/>\n</parser>'
    documents = rows([(n, document.format(n)) for n in ("B", "C")], "source_name string, parser_xml string")
    write_rules(documents.coalesce(1), out)
    written = read_rules(spark, out)
    assert rule_list(written, "B") == [("a", "b"), ("c", "B")]
    assert rule_list(written, "C") == [("a", "b"), ("c", "C")]


def test_reader_registry(spark, rows):
    register_reader("Memory", lambda spark, spec, at: rows([(at.last,)], "value string"))
    try:
        assert read_source(spark, SourceSpec(type="memory"), Position("x")).first()[0] == "x"
    finally:
        READERS.pop("memory")
    with pytest.raises(ValueError):
        read_source(spark, SourceSpec(type="s4"))
