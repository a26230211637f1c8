"""Connected components on paths, stars, cycles and random graphs."""

import random

import pytest

from logweir.llm.components import components
from logweir.llm.tables import run_folder


def _least(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in list(root) if find(x) != x}


@pytest.mark.parametrize("kind", ["none", "path", "star", "cycle", "random", "loops"])
def test_components(spark, kind):
    rng = random.Random(3)
    edges = {
        "none": [],
        "path": [(i, i + 1) for i in range(40)],
        "star": [(7, i) for i in range(30) if i != 7],
        "cycle": [(i, (i + 1) % 25) for i in range(25)] + [(100, 101)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(220)],
        "loops": [(1, 1), (2, 3), (3, 2), (2, 3)],
    }[kind]
    got = components(spark.createDataFrame(edges, "a long, b long"), run_folder(spark)).collect()
    assert {r.a: r.root for r in got} == _least(edges) and len(got) == len(_least(edges))
