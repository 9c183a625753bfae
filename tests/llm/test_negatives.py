"""Hard negatives against brute force, and the index against its bounds."""

import math

import numpy as np
import pytest

from terraloom.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score string, rank string, x string"


def make_rows(seed: int, n: int = 700, width: int = 9):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (6, width))
    rows = []
    for i in range(n):
        x = (centres[rng.integers(6)] + rng.normal(0, 0.4, width)).tolist()
        if i % 40 == 3:
            x[rng.integers(width)] = [math.nan, math.inf, -math.inf, None, 1e30][i % 5]
        rows.append((i, x, int(rng.integers(4))))
    rows += [(n + k, rows[k % 3 + 10][1], k % 4) for k in range(250)]  # a third of all rows are copies of few vectors
    rows += [(None, rows[0][1], 1), (1, None, 1), (2, rows[1][1], None), (100, rows[5][1], 2), (100, rows[6][1], 2), (300, [], 1), (400, [1.0, 2.0], 3), (3, [0.0] * width, 0), (-100, rows[7][1], 1), (2**60, rows[8][1], 0)]
    return [(*r, "a", "b", "c", "d") for r in rows]


def brute_force(rows):
    kept = []
    for at, (i, x, y, *_) in enumerate(rows):
        if i is None or x is None or y is None or any(v is None or not math.isfinite(v) or abs(v) >= negatives.LIMIT / 256 for v in x):
            continue
        kept.append((at, i, (y + 1) % 10 if i % 7 == 0 else y, [math.floor(256 * float(np.float32(v))) for v in x]))
    out = []
    for at, i, y, x in kept:
        if i % 100:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(x, v)), j, k, z) for k, j, z, v in kept if k != at))
        for s, j, _, _ in [r for r in scored if r[3] == y][:5]:
            fit = [(-t, m) for t, m, _, z in scored if z != y and 30 * -s <= 100 * -t <= 90 * -s][:10]
            out += [(i, j, r + 1, m, -s, t) for r, (t, m) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize(("seed", "values", "least"), [(1, 1 << 22, 1024), (2, 700, 50), (3, 40, 10)])
def test_equals_brute_force(spark, seed, values, least, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_VALUES", values)
    monkeypatch.setattr(negatives, "LEAST_ROWS", least)
    rows = make_rows(seed, 150 if values < 100 else 700)
    got = negatives.mine(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert got and sorted(map(tuple, got)) == brute_force(rows)


def test_empty_and_single(spark):
    assert negatives.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame(make_rows(1)[:1], SCHEMA)
    assert negatives.mine(one).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_cells_come_by_falling_bounds_that_hold(seed):
    rng = np.random.default_rng(seed)
    x = np.floor(rng.normal(0, 200, (400, 10)) + 300 * rng.integers(0, 3, (400, 1)))
    books = negatives.codebook(x[:100, :5]), negatives.codebook(x[:100, 5:])
    index = negatives.MultiIndex(x, books)
    query = np.floor(rng.normal(0, 200, 10))
    seen, last = [], np.inf
    for bound, places in index.visits(query):
        assert bound <= last and index.scores(query, places).max() <= bound
        last = bound
        seen += places.tolist()
    assert sorted(seen) == list(range(400))


def test_a_search_stops_when_its_windows_are_certified(monkeypatch):
    rng = np.random.default_rng(0)
    x = np.floor(np.concatenate([rng.normal(c, 5, (200, 8)) for c in (-800, -300, 300, 800)]))
    index = negatives.MultiIndex(x, (negatives.codebook(x[:, :4]), negatives.codebook(x[:, 4:])))
    scored = []
    score = index.scores
    monkeypatch.setattr(negatives, "TOGETHER", 1)
    monkeypatch.setattr(index, "scores", lambda q, at: scored.append(len(at)) or score(q, at))
    (places, scores), *_ = index.search(np.full(8, 500.0), np.ones(800, bool), np.arange(800)[index.order], [(None, None)], 5)
    assert scores.tolist() == sorted((x @ np.full(8, 500.0)).astype(int).tolist())[::-1][:5] and sum(scored) <= 200


def test_large_components_are_exact():
    x = np.array([[2.0**24 - 1] * 12, [2.0**24 - 3] * 12])
    index = negatives.MultiIndex(x, (negatives.codebook(x[:, :6]), negatives.codebook(x[:, 6:])))
    got = dict(zip(index.order.tolist(), index.scores(x[0], np.arange(2)).tolist()))
    assert got == {0: 12 * (2**24 - 1) ** 2, 1: 12 * (2**24 - 1) * (2**24 - 3)}
