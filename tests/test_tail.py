"""Files that grow: byte ranges, places, replaced and cut files, batches and streams."""

import gzip
import os
import random
from dataclasses import replace

import pytest

from logweir.plans.ingest import run_source
from logweir.plans.store import Store
from logweir.schemas import FILES
from logweir.sources.files import present_files, read_lines
from logweir.sources.spec import SourceSpec
from logweir.sources.tail import listed, planned_lines, planned_reads, range_lines
from logweir.streaming.ingest import source_stream, start_loading

LINE = "[allow] src=10.0.0.1 dst=10.0.0.2 dst_port=443 proto=TCP service=Jira bytes=512"


@pytest.fixture
def logs(spark, tmp_path):
    (tmp_path / "logs").mkdir()

    def write(name, text, mode="a"):
        with open(tmp_path / "logs" / name, mode, encoding="utf-8", newline="") as f:
            f.write(text)

    spec = SourceSpec(name="Firewall_Logs", type="tail", path=f"{tmp_path}/logs/*.log")
    return write, spec, Store(spark, str(tmp_path / "store"))


def _plain(data):
    out, at = [], 0
    for whole in data.split(b"\n")[: -1 if data.endswith(b"\n") else None] if data else []:
        out.append((whole.removesuffix(b"\r").decode("utf-8", "replace"), f"f:{at}"))
        at += len(whole) + 1
    return out


@pytest.mark.parametrize("seed", range(12))
def test_ranges_give_each_line_once(tmp_path, seed, monkeypatch):
    import pyarrow.fs as fs

    from logweir.sources import tail

    monkeypatch.setattr(tail, "CHUNK_BYTES", 7)
    rnd = random.Random(seed)
    data = b"".join(rnd.choice([b"a", b"bc" * 9, b"", "é".encode(), b"\xff", b"\r"]) + rnd.choice([b"\n", b"\r\n", b""]) for _ in range(rnd.randint(0, 60)))
    (tmp_path / "f").write_bytes(data)
    step, got = rnd.randint(1, 40), []
    with fs.LocalFileSystem().open_input_file(str(tmp_path / "f")) as file:
        for begin in range(0, len(data), step):
            for batch in range_lines(file, begin, min(begin + step, len(data)), len(data), "f"):
                got += zip(*(c.to_pylist() for c in batch.columns), strict=True)
    assert got == _plain(data)


def test_range_borders_in_spark(spark, logs):
    write, spec, _ = logs
    write("a b%41.log", "".join(f"line {i}\n" * (i % 3) for i in range(200)) + "no end")
    plan = planned_reads(present_files(spark, spec), spark.createDataFrame([], FILES))
    whole = sorted(map(tuple, planned_lines(plan).collect()))
    assert sorted(map(tuple, planned_lines(plan, range_bytes=37).collect())) == whole
    assert len(whole) == len({p for _, p in whole}) == sum(i % 3 for i in range(200)) + 1


def test_equal_lines_of_a_grown_file_stay_as_many(spark, logs):
    """Also where the file is read whole again, beside a new one, or after a failed load."""
    write, spec, _ = logs
    for kind in ("file", "tail"):
        store = Store(spark, f"{spec.path[:-6]}/../{kind}")
        own = replace(spec, type=kind, path=spec.path.replace("*", f"{kind}*"))
        write(f"{kind}.log", f"{LINE}\n" * 20)
        assert run_source(spark, store, own, seq=1) == 20
        write(f"{kind}.log", f"{LINE}\n")
        write(f"{kind}-more.log", f"{LINE}\n" * 3000)
        assert run_source(spark, store, own, seq=2) == (3021 if kind == "file" else 3001)
        assert store.alerts.alerts().count() == 3021
        assert run_source(spark, store, own, seq=3) == 0


def test_a_failed_load_is_repeated_beside_a_new_file(spark, logs, monkeypatch):
    write, spec, store = logs
    write("a.log", f"{LINE}\n" * 20)
    with monkeypatch.context() as patched:
        patched.setattr(Store, "save_cursor", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run_source(spark, store, spec, seq=1)
    write("b.log", f"{LINE}\n" * 500)
    run_source(spark, store, spec, seq=2)
    assert store.alerts.alerts().count() == 520


def test_replaced_and_cut_files_begin_again(spark, logs):
    write, spec, store = logs
    write("a.log", f"{LINE}\n" * 5)
    write("b.log", "".join(f"{LINE}{i}\n" for i in range(9)))
    assert run_source(spark, store, spec, seq=1) == 14
    write("a.log", f"{LINE}\n" * 3, "w")  # cut: what is in it came after
    write("b.log", f"{LINE} other\n" * 20, "w")  # replaced by a longer one
    assert run_source(spark, store, spec, seq=2) == 23
    assert store.alerts.alerts().count() == 14 + 23
    files = {os.path.basename(r["path"]): r["generation"] for r in store.files(spec.name).collect()}
    assert files == {"a.log": 1, "b.log": 1}
    store.merge(keep=0)
    write("a.log", f"{LINE}\n")
    assert run_source(spark, store, spec, seq=3) == 1


@pytest.mark.parametrize("unfinished", ["take", "wait"])
def test_a_line_without_its_end(spark, logs, unfinished):
    write, spec, store = logs
    spec = replace(spec, unfinished=unfinished)
    write("a.log", f"{LINE}\n{LINE}")
    assert run_source(spark, store, spec, seq=1) == (2 if unfinished == "take" else 1)
    write("a.log", "\n")
    assert run_source(spark, store, spec, seq=2) == 1
    assert store.alerts.alerts().count() == 2  # the line that was taken too early is replaced


def test_packed_files_are_read_whole(spark, tmp_path):
    with gzip.open(tmp_path / "a.gz", "wb") as f:
        f.write(b"one\ntwo\r\n" * 3000)
    got = read_lines(spark, SourceSpec(type="file", path=f"{tmp_path}/*.gz")).collect()
    assert len(got) == len({r["place"] for r in got}) == 6000 and {r["value"] for r in got} == {"one", "two"}


def test_a_stream_follows_files(spark, logs, tmp_path):
    write, spec, store = logs
    checkpoint = str(tmp_path / "checkpoint")

    def follow():
        start_loading(source_stream(spark, spec), store, spec, checkpoint, once=True).awaitTermination()
        return store.alerts.alerts().count()

    write("a.log", f"{LINE}\n" * 20)
    assert follow() == 20
    write("a.log", f"{LINE}\n" * 2)
    write("b.log", f"{LINE}\n" * 7)
    assert follow() == 29
    assert follow() == 29
    write("a.log", f"{LINE}\n", "w")
    assert follow() == 30
    assert sorted(r["processed_count"] for r in store.history().collect() if r["processed_count"]) == [1, 9, 20]


def test_what_a_path_stands_for(tmp_path):
    for name in ("a.log", "b.txt", "_SUCCESS", "in/c.log", "in/deep/d.log"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    names = lambda p: sorted(os.path.relpath(x.removeprefix("file:"), tmp_path) for x in listed(p))
    assert names(f"{tmp_path}") == ["a.log", "b.txt"]
    assert names(f"{tmp_path}/*.log") == ["a.log"]
    assert names(f"{tmp_path}/i*") == ["in/c.log"]
    assert names(f"{tmp_path}/in/c.log") == ["in/c.log"]
    assert names(f"{tmp_path}/none/*") == []


def test_a_watermark_moves_with_the_batches(spark, logs, tmp_path):
    """Rows are late by more than the delay behind what came before; a repeated batch judges alike."""
    write, _, store = logs
    spec = SourceSpec(name="Auth_Logs", type="tail", path=f"{tmp_path}/logs/*.log", late_policy="watermark", late_delay="10 seconds")
    line = lambda s: f'{{"timestamp":"2026-01-01T00:00:{s:02d}","user_id":"E{s}","action":"login"}}\n'
    for name, seconds in (("a.log", (40, 5)), ("b.log", (29, 30, 31, 55)), ("a.log", (45, 44))):
        write(name, "".join(map(line, seconds)))
        start_loading(source_stream(spark, spec), store, spec, str(tmp_path / "checkpoint"), once=True).awaitTermination()
    # the second batch is judged by 40 - 10, the third by 55 - 10
    assert sorted(r["timestamp"][-2:] for r in store.alerts.alerts().collect()) == ["05", "30", "31", "40", "45", "55"]
    late = {r["id"]: r["late_count"] for r in store.history().collect()}
    assert late == {"Auth_Logs-0": 0, "Auth_Logs-1": 1, "Auth_Logs-2": 1}
    text = "a line without any time\n"
    write("c.log", text)
    start_loading(source_stream(spark, spec), store, spec, str(tmp_path / "checkpoint"), once=True).awaitTermination()
    assert sum(r["late_count"] for r in store.history().collect()) == 3  # it has the epoch
