"""Connected components against union-find on random graphs, whatever the number of partitions."""

import random

import pytest

from terraloom.operators.components import connected_components


@pytest.mark.parametrize(("seed", "parts"), [(0, 1), (1, 7)])
def test_components(spark, seed, parts):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)] + [(999, 999), (5, None)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        if b is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long").repartition(parts)).collect()}
    assert got == {i: find(i) for i in root}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0
