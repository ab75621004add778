import random

import pytest

from tastegraph.llm.components import components


def brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_components(spark, kind):
    rng = random.Random(4)
    edges = {
        "chain": [(i, i + 1) for i in range(60)] + [(100, 101)],
        "star": [(500, i) for i in range(200)] + [(1000, 999)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(180)],
    }[kind]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in brute([e for e in edges if e[0] != e[1]]).items()}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0
