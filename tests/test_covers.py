"""Covers against the cells by definition, and the join by covers against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.functions import geometry as G
from terraloom.operators import covers, repair


def star(rng, cx, cy, size, n=9):
    t = np.linspace(0, 2 * np.pi, n + 1)[:-1]
    p = np.stack([cx + np.cos(t) * size * rng.uniform(0.3, 1, n), cy + np.sin(t) * size * rng.uniform(0.3, 1, n)], 1)
    return [[np.vstack([p, p[:1]])]]


def area(g):
    ring = lambda r: abs(sum((a[0] - r[0][0]) * (b[1] - r[0][1]) - (b[0] - r[0][0]) * (a[1] - r[0][1]) for a, b in zip(r, r[1:]))) / 2
    return sum(ring(p[0]) - sum(map(ring, p[1:])) for p in g)


def places(keys):
    level, x, y = keys >> 2 * covers.BITS + 4, (keys >> covers.BITS) & (2**covers.BITS - 1), keys & (2**covers.BITS - 1)
    sign = lambda v: np.where(v >= 2 ** (covers.BITS - 1), v - 2**covers.BITS, v)
    return level, sign(x), sign(y)


@pytest.mark.parametrize("seed", range(6))
def test_a_cover_holds_the_shape_and_little_more(seed):
    rng = np.random.default_rng(seed)
    g = star(rng, rng.uniform(-60, 60), rng.uniform(-60, 60), 50)
    if seed % 2:
        g[0].append(star(rng, *g[0][0].mean(0), 8)[0][0])
    own, up = covers.cover(g, 1.0, 5)
    level, x, y = places(own)
    ground = {}
    for l, i, j in zip(level.tolist(), x.tolist(), y.tolist()):
        for a in range(i << l, (i + 1) << l):
            for b in range(j << l, (j + 1) << l):
                assert (a, b) not in ground  # no cell lies in another
                ground[a, b] = l
    s = repair._segments(g)
    fine = {tuple(c) for c in covers._walked(s, 1.0).tolist()}
    box = [(a, b) for a in range(-130, 130) for b in range(-130, 130)]
    inside = covers._inside(s, np.array([a + 0.5 for a, _ in box]), np.array([b + 0.5 for _, b in box]))
    assert set(ground) == fine | {c for c, v in zip(box, inside) if v}
    ancestors = set(zip(*(v.tolist() for v in places(up))))
    want = set()
    for l, i, j in zip(level.tolist(), x.tolist(), y.tolist()):
        want |= {(k, i >> (k - l), j >> (k - l)) for k in range(l + 1, 6)}
    assert ancestors == want


def test_rows_are_bounded_by_the_outline():
    """A triangle with sides of 200 km in cells of 64 m: a box of ten million tiles."""
    p = np.array([(500_000, 6_000_000), (700_000, 6_000_000), (600_000, 6_173_000), (500_000, 6_000_000)], float)
    own, up = covers.cover([[p]], 64.0)
    outline = 3 * 200_000 / 64
    assert len(own) < 6 * outline and len(up) < 3 * outline


def test_join_equals_all_pairs(spark):
    rng = np.random.default_rng(5)
    shapes = [[star(rng, *rng.uniform(-100, 100, 2), s) for s in sizes] for sizes in (rng.uniform(2, 20, 60), [*rng.uniform(1, 10, 50), 90, 140])]
    frame = lambda gs, name: spark.createDataFrame([(i, [[[tuple(map(float, q)) for q in r] for r in p] for p in g]) for i, g in enumerate(gs)] + [(1000, []), (1001, None)], f"{name} long, geometry {G.GEOMETRY}")
    want = {}
    for i, a in enumerate(shapes[0]):
        for j, b in enumerate(shapes[1]):
            common = area(repair.overlay([a, b], all))
            if common > 0:
                want[i, j] = common
    for size, levels in ((4.0, 6), (None, 16), (30.0, 0)):
        got = {(r.p, r.q): r.common for r in covers.cover_join(frame(shapes[0], "p"), frame(shapes[1], "q"), "p", "q", size, levels).collect()}
        assert got == pytest.approx(want)


def test_no_layer_is_broadcast(spark):
    """Neither cells, ancestors nor geometries go through the driver, small as the planner holds them to be."""
    square = lambda x, y, side: F.array(F.array(F.array(*(F.struct((x + i * side).cast("double").alias("x"), (y + j * side).cast("double").alias("y")) for i, j in ((0, 0), (0, 1), (1, 1), (1, 0), (0, 0))))))
    layer = lambda name, step: spark.range(40).select(F.col("id").alias(name), square(F.col("id") * step, F.col("id") * 0, 4).alias("geometry"))
    wide = spark.range(1).select(F.lit(-1).cast("long").alias("q"), square(F.col("id") - 10, F.col("id") - 10, 1000).alias("geometry"))
    out = covers.cover_join(layer("p", 8), layer("q", 8).unionByName(wide), "p", "q", 5.0)
    assert sorted(map(tuple, out.collect())) == sorted([(i, j, 16.0) for i in range(40) for j in (i, -1)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 4 and "Broadcast" not in plan
