"""The overlay against areas by sampling and by its own identities, and its time on large polygons."""

import random
import time

import numpy as np
import pytest

from terraloom.operators import repair


def area(polygons):
    ring = lambda r: abs(sum((a[0] - r[0][0]) * (b[1] - r[0][1]) - (b[0] - r[0][0]) * (a[1] - r[0][1]) for a, b in zip(r, r[1:]))) / 2
    return sum(ring(p[0]) - sum(map(ring, p[1:])) for p in polygons)


def covered(polygons, x, y):
    inside = np.zeros(len(x), bool)
    for p in polygons:
        for r in p:
            r = np.asarray(r)
            for a, b in zip(r, r[1:]):
                if a[1] != b[1]:
                    inside ^= ((a[1] > y) != (b[1] > y)) & (x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0])
    return inside


def blob(rng, n, cx, cy, size):
    t = np.linspace(0, 2 * np.pi, n + 1)[:-1]
    d = size * (1 + 0.4 * np.sin(3 * t + rng.uniform(0, 6)) + 0.2 * np.cos(7 * t + rng.uniform(0, 6)))
    p = np.stack([cx + d * np.cos(t), cy + d * np.sin(t)], 1)
    return [[np.vstack([p, p[:1]])]]


@pytest.mark.parametrize("seed", range(6))
def test_groups_cover_what_their_shapes_cover(seed, monkeypatch):
    rng = random.Random(seed)
    if seed % 2:  # many small steps give the same
        monkeypatch.setattr(repair, "PAIRS", 50)
        monkeypatch.setattr(repair, "SLABS", 40)
    groups = [[blob(rng, rng.randint(3, 40), rng.uniform(0, 100), rng.uniform(0, 100), rng.uniform(5, 40)) for _ in range(rng.randint(1, 6))] for _ in range(3)]
    points = np.random.default_rng(seed).uniform(-60, 160, (3000, 2))
    x, y = points.T
    inside = [np.logical_or.reduce([covered(g, x, y) for g in group]) for group in groups]
    for keep in (any, all, lambda i: i[0] and i[1] and not i[2], lambda i: (i[0] + i[1] + i[2]) % 2):
        got = covered(repair.overlay_groups(groups, keep), x, y)
        want = np.array([bool(keep([bool(v) for v in at])) for at in zip(*inside)])
        assert (got != want).sum() <= 2  # points within the snap of an edge


def test_copies_and_shared_edges():
    box = lambda a, b, c, d: [[[(a, b), (a, d), (c, d), (c, b), (a, b)]]]
    many = [box(10 * i, 0, 10 * i + 15, 15) for i in range(40)] * 2
    assert area(repair.overlay_groups([many], any)) == pytest.approx(15 * (39 * 10 + 15))
    assert len(repair.overlay_groups([many], any)) == 1
    assert repair.overlay_groups([[], []], any) == [] and repair.overlay_groups([many, []], all) == []


def test_time_grows_with_the_vertices_not_their_square():
    took = []
    for n in (5_000, 50_000):
        rng = random.Random(1)
        a, b = blob(rng, n, 0, 0, 10_000), blob(rng, n, 3_000, 0, 10_000)
        began = time.process_time()
        common, either = repair.overlay([a, b], all), repair.overlay([a, b], any)
        took.append(time.process_time() - began)
        assert area(common) + area(either) == pytest.approx(area(a) + area(b), rel=1e-6)
    assert took[1] < 20 * took[0]


def all_pairs_cross(s):
    """The definition, for each pair by itself."""
    side = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    for i in range(len(s)):
        for j in range(i):
            a, b, c, d = s[i, :2], s[i, 2:], s[j, :2], s[j, 2:]
            s1, s2, s3, s4 = side(a, b, c), side(a, b, d), side(c, d, a), side(c, d, b)
            if s1 * s2 < 0 and s3 * s4 < 0:
                return True
            if s1 == 0 and s2 == 0:
                axis = b - a
                u, v = sorted(((c - a) @ axis, (d - a) @ axis))
                if min(v, axis @ axis) > max(u, 0):
                    return True
    return False


@pytest.mark.parametrize("seed", range(8))
def test_self_crossing_equals_all_pairs(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    if seed % 2:
        monkeypatch.setattr(repair, "PAIRS", 5)
    answers = set()
    for _ in range(60):
        n = int(rng.integers(3, 12))
        t = np.sort(rng.uniform(0, 2 * np.pi, n))
        p = np.stack([np.cos(t), np.sin(t)], 1) * rng.uniform(20, 100, (n, 1)) if rng.random() < 0.7 else rng.integers(0, 9, (n, 2)).astype(float)
        p = np.round(p, int(rng.integers(0, 3)))
        g = [[np.vstack([p, p[:1]])]]
        want = all_pairs_cross(repair._segments(g))
        assert repair.crosses_itself(g) == want
        answers.add(want)
    assert answers == {True, False}


def test_pairs_that_meet_are_near():
    rng = np.random.default_rng(3)
    s = np.concatenate([rng.uniform(0, 100, (60, 4)), rng.integers(0, 100, (60, 4)).astype(float), np.array([[0, 0, 100, 100], [0, 50, 100, 50], [50, 0, 50, 100], [0, 100, 100, 0]], float)])
    seen = {tuple(sorted(p)) for i, j in repair.near_pairs(s) for p in zip(i.tolist(), j.tolist())}
    for i in range(len(s)):
        for j in range(i):
            if all_pairs_cross(s[[i, j]]):
                assert (j, i) in seen


def test_a_million_vertices_in_seconds():
    rng = random.Random(2)
    g = blob(rng, 1_000_000, 0, 0, 50_000)
    began = time.process_time()
    assert not repair.crosses_itself(g)
    g[0][0][500_000] *= -2  # out through the other side
    assert repair.crosses_itself(g)
    assert time.process_time() - began < 30
