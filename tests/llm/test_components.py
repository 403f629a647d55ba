import random

import pytest

from stockout.llm.components import connected_components


def brute(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in list(parent)}


RANDOM = random.Random(2)


@pytest.mark.parametrize("edges", [
    [], [(1, 1), (None, 2), (3, None)], [(i, i + 1) for i in range(100)], [(0, i) for i in range(1, 50)] * 2,
    [(RANDOM.randrange(300), RANDOM.randrange(300)) for _ in range(200)],
    [(2 * i, 2 * i + 2) for i in range(30)] + [(99, 97), (97, 95), (95, 99), (-3, 99)],
])
def test_components_match_union_find(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r["node"]: r["component"] for r in connected_components(df).collect()} == brute(edges)
