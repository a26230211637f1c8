"""What near dedup sends and leaves on disk, and that its bits part no similar documents."""

import time

import brute
import numpy as np
import pytest
from test_llm_operators import _same, _story, make, repeated  # noqa: F401  make is a fixture

from logweir.llm import jaccard
from logweir.llm.jaccard import alike, set_bits
from logweir.llm.tables import run_folder, written


def _sets(rng, count):
    out = []
    for k in range(count):
        base = rng.integers(0, 2**63, int(rng.choice([1, 3, 40, 60, 70, 130, 1500])), dtype=np.uint64)
        out.append(np.unique(base))
        if k % 3 == 0:
            kept = base[rng.random(len(base)) < rng.choice([0.5, 0.8, 0.9, 0.95, 1])]
            out.append(np.unique(np.r_[kept, rng.integers(0, 2**63, int(len(base) * rng.choice([0, 0.1, 0.25])), dtype=np.uint64)]))
    return [s for s in out if len(s)]


def _similar(a, b, percent):
    common = len(np.intersect1d(a, b))
    return 100 * common >= percent * (len(a) + len(b) - common)


@pytest.mark.parametrize("percent", [1, 30, 50, 80, 90, 100])
@pytest.mark.parametrize("two", [False, True])
def test_bits_part_no_similar_sets(percent, two):
    rng = np.random.default_rng(percent)
    sets = _sets(rng, 90)
    group = np.sort(rng.integers(0, 4, len(sets)))
    order = np.lexsort([[len(s) for s in sets], group])
    sets, n, side = [sets[i] for i in order], np.array([len(sets[i]) for i in order]), rng.integers(0, 2, len(sets))
    kept = alike(group, n, np.arange(len(sets)), side, np.full(len(sets), two), [set_bits(s, percent) for s in sets], percent)
    partner = [
        any(i != j and group[i] == group[j] and (not two or side[i] != side[j]) and _similar(sets[i], sets[j], percent) for j in range(len(sets)))
        for i in range(len(sets))
    ]
    assert kept[partner].all() and any(partner)
    if percent >= 50:  # long sets that have hardly a shingle in common do not go on
        alone = [not any(i != j and len(np.intersect1d(sets[i], sets[j])) for j in range(len(sets))) for i in range(len(sets))]
        assert not kept[np.array(alone) & (n >= 1000)].any()


def test_a_set_is_no_partner_of_itself():
    bits = [set_bits(np.arange(9, dtype=np.uint64), 80)] * 2
    same = np.zeros(2, np.int64)
    assert not alike(same, same + 9, same + 5, same, same > 0, bits, 80).any()
    assert alike(same, same + 9, np.array([5, 6]), same, same > 0, bits, 80).all()
    assert not len(alike(same[:0], same[:0], same[:0], same[:0], same[:0] > 0, [], 80))


def test_texts_go_only_to_likely_partners(spark, make, monkeypatch, tmp_path):  # noqa: F811
    """Neighbours share rare shingles, half of all; only two documents are similar."""
    monkeypatch.setattr(jaccard, "run_folder", lambda spark: f"{tmp_path}/run")
    parts = [_story(1000 + k, 60) for k in range(41)]
    pairs = [(k, f"{parts[k]} {parts[k + 1]}") for k in range(40)]
    pairs += [(100, pairs[7][1].replace(" ", " new ", 1)), (101, None)]
    _same(jaccard.similar_documents(make(pairs), 5, 80), brute.similar_rows(pairs, 5, 80))
    assert {r.member for r in spark.read.parquet(f"{tmp_path}/run/alike").collect()} == {7, 100}
    for name in ("sets", "groups", "met", "partners"):
        assert not (tmp_path / "run" / name).exists()


@pytest.mark.parametrize("members", [3, 8192])
def test_bits_of_large_buckets_meet_in_blocks(spark, make, monkeypatch, members):  # noqa: F811
    monkeypatch.setattr(jaccard, "BITS_MEMBERS", members)
    rng = np.random.default_rng(1)
    base, pairs = _story(7, 90).split(), repeated()
    for k in range(40):
        own = list(base)
        for at in rng.integers(0, len(own), rng.integers(0, 12)):
            own[at] = f"q{rng.integers(0, 30)}"
        pairs.append((200 + k, " ".join(own)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")  # buckets go on in the next batch
    try:
        _same(jaccard.similar_documents(make(pairs), 3, 80), brute.similar_rows(pairs, 3, 80))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    kept = written(spark.range(100_000).repartition(3, "id"), f"{run_folder(spark)}/rows")
    until = time.time() + 10  # they go in the background
    while (more := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    assert not more and kept.count() == 100_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
