"""Connected components against union-find."""
import random

import pytest

from intake_spark.llm import components
from intake_spark.llm.components import connected_components


def union_find(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


def run(spark, edges, kind="long"):
    got = connected_components(spark.createDataFrame(edges, f"a {kind}, b {kind}")).collect()
    assert len(got) == len({r.id for r in got})
    return {r.id: r.component for r in got}


@pytest.mark.parametrize("small", [0, 100, 10**6])
def test_paths_stars_and_random_graphs(spark, monkeypatch, small):
    monkeypatch.setattr(components, "SMALL", small)
    rnd = random.Random(1)
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, i) for i in range(1001, 1400)]
    some = [(rnd.randrange(2000, 2300), rnd.randrange(2000, 2300)) for _ in range(140)]
    edges = path + star + some + path[:5]
    rnd.shuffle(edges)
    assert run(spark, edges) == union_find([(a, b) for a, b in edges if a != b])


def test_strings_nulls_loops_and_nothing(spark):
    assert run(spark, [("b", "a"), ("c", None), (None, "d"), ("e", "e"), ("b", "z")], "string") == {"a": "a", "b": "a", "z": "a"}
    assert run(spark, []) == {}
