"""Dissolved grid components against the cells that they are made of."""

import random

import pytest
from pyspark.sql import functions as F

from terraloom.functions import geometry as G
from terraloom.operators import spatial

SCHEMA = f"id long, component_id long, geometry {G.GEOMETRY}"


def square(x, y, w=1, h=1):
    ring = [(x, y), (x, y + h), (x + w, y + h), (x + w, y), (x, y)]
    return [[[(10.0 * a, 10.0 * b) for a, b in ring]]]


def rolled(ring):
    corners = [(round(p["x"] / 10), round(p["y"] / 10)) for p in ring]
    assert corners[0] == corners[-1]
    corners = corners[:-1]
    i = corners.index(min(corners))
    return tuple(corners[i:] + corners[:i])


def area(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1])) / 2


def covers(shell, holes, x, y):
    inside = lambda r: sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(r, r[1:] + r[:1])) % 2
    return inside(shell) and not any(inside(h) for h in holes)


@pytest.mark.parametrize("seed", range(2))
def test_random_cells(spark, seed):
    rng = random.Random(seed)
    groups = {g: {(rng.randrange(n), rng.randrange(n)) for _ in range(int(n * n * share))} for g, (n, share) in enumerate([(12, 0.4), (14, 1.2), (9, 2.5), (5, 0.3), (16, 0.8)])}
    groups[9] = {(x, y) for x in range(11) for y in range(11) if max(abs(x - 5), abs(y - 5)) in (1, 3, 5)} | {(5, 5)}  # rings in rings
    rows = [(i, g, square(*c)) for g, cells in groups.items() for i, c in enumerate(sorted(cells))]
    got = {r.component_id: r.geometry for r in spatial.stitch(spatial.boundary(spark.createDataFrame(rows, SCHEMA), ["component_id"]), ["component_id"]).collect()}
    assert set(got) == set(groups)
    for g, cells in groups.items():
        polygons = [[rolled(r) for r in p] for p in got[g]]
        assert sum(abs(area(p[0])) - sum(abs(area(h)) for h in p[1:]) for p in polygons) == len(cells)
        assert all(area(p[0]) < 0 and all(area(h) > 0 for h in p[1:]) for p in polygons)
        for x in range(-1, 17):
            for y in range(-1, 17):
                assert sum(bool(covers(p[0], p[1:], x + 0.5, y + 0.5)) for p in polygons) == ((x, y) in cells)
        # Cells that touch in a point alone are parts of their own.
        seen, parts = set(), 0
        for c in cells:
            parts += c not in seen
            todo = [c]
            while todo:
                x, y = todo.pop()
                if (x, y) in cells and (x, y) not in seen:
                    seen.add((x, y))
                    todo += [(x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)]
        assert len(polygons) == parts


def test_features_of_several_sizes_and_with_holes(spark):
    big = square(0, 0, 6, 6)[0] + [[(10.0 * a, 10.0 * b) for a, b in [(2, 2), (4, 2), (4, 4), (2, 4), (2, 2)]]]
    rows = [(1, 1, [big]), (2, 1, square(6, 0, 2, 1)), (3, 1, square(2, 2, 1, 2))]
    (r,) = spatial.stitch(spatial.boundary(spark.createDataFrame(rows, SCHEMA), ["component_id"]), ["component_id"]).collect()
    (p,) = r.geometry
    assert [rolled(x) for x in p] == [((0, 0), (0, 6), (6, 6), (6, 1), (8, 1), (8, 0)), ((3, 2), (4, 2), (4, 4), (3, 4))]


def test_no_edges(spark):
    assert spatial.stitch(spatial.boundary(spark.createDataFrame([], SCHEMA), ["component_id"]), ["component_id"]).count() == 0


def test_a_component_of_a_hundred_thousand_cells(spark):
    """A comb: one ring of two hundred thousand steps, and a field of holes."""
    n = 360
    rows = spark.range(n * n).select((F.col("id") % n).alias("x"), F.floor(F.col("id") / n).alias("y")).where("x % 2 = 0 OR y = 0 OR (x % 4 = 1 AND y % 30 = 7)")
    count = rows.count()
    assert count < 10**5
    more = spark.range(200 * 200).select((F.col("id") % 200 + n).alias("x"), F.floor(F.col("id") / 200).alias("y")).where("NOT (x % 5 = 2 AND y % 5 = 2)")
    cells = rows.unionByName(more)
    total = cells.count()
    assert total > 10**5
    x, y = F.col("x") * 10.0, F.col("y") * 10.0
    corner = lambda dx, dy: G.point(x + dx, y + dy)
    ring = F.array(corner(0, 0), corner(0, 10.0), corner(10.0, 10.0), corner(10.0, 0), corner(0, 0))
    df = cells.select((F.col("x") * 1000 + F.col("y")).alias("id"), F.lit(1).cast("long").alias("component_id"), F.array(F.array(ring)).alias("geometry"))
    out = spatial.stitch(spatial.boundary(df, ["component_id"]), ["component_id"])
    assert "Pandas" not in out._jdf.queryExecution().toString()
    r = out.select(F.size("geometry").alias("parts"), G.area(F.col("geometry")).alias("area"), F.aggregate("geometry", F.lit(0), lambda a, p: a + F.size(p) - 1).alias("holes")).head()
    assert (r.parts, r.area) == (1, total * 100.0)
    assert r.holes >= 40 * 40
