"""Overlay, repair, validity and codecs: areas by inclusion and exclusion, literal shapes, round trips."""

import random
import struct
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.functions import geometry as G
from terraloom.functions import wkb
from terraloom.operators import repair
from terraloom.session import ROOT


def ring(*points):
    return np.array([*points, points[0]], float)


def rows_of(g):
    """A geometry as Spark takes it."""
    return g if g is None else [[[{"x": float(x), "y": float(y)} for x, y in r] for r in p] for p in g]


def box(x0, y0, x1, y1):
    return [[ring((x0, y0), (x0, y1), (x1, y1), (x1, y0))]]


def area(g):
    total = 0.0
    for p in g:
        for i, r in enumerate(p):
            a = abs(sum(u[0] * v[1] - v[0] * u[1] for u, v in zip(r, r[1:], strict=False)) / 2)
            total += a if i == 0 else -a
    return total


def test_overlay_of_boxes():
    a, b = box(0, 0, 4, 4), box(2, 2, 6, 6)
    assert area(repair.overlay([a, b], any)) == pytest.approx(28)
    assert area(repair.overlay([a, b], all)) == pytest.approx(4)
    assert area(repair.overlay([a, b], lambda i: i[0] and not i[1])) == pytest.approx(12)
    assert len(repair.overlay([a, b], any)) == 1
    assert len(repair.overlay([a, box(8, 0, 9, 1)], any)) == 2
    hole = repair.overlay([box(0, 0, 6, 6), box(2, 2, 4, 4)], lambda i: i[0] and not i[1])
    assert [len(p) for p in hole] == [2]
    assert area(hole) == pytest.approx(32)
    assert repair.overlay([[], []], any) == []
    assert len(repair.overlay([box(0, 0, 1, 1), box(1, 1, 2, 2)], any)) == 2
    assert len(repair.overlay([box(0, 0, 1, 1), box(1, 0, 2, 1)], any)) == 1


@pytest.mark.parametrize("seed", range(30))
def test_overlay_areas_add_up(seed):
    rng = random.Random(seed)

    def triangle():
        return [[ring(*((rng.uniform(0, 100), rng.uniform(0, 100)) for _ in range(3)))]]

    a, b = triangle(), triangle()
    union, common = repair.overlay([a, b], any), repair.overlay([a, b], all)
    rest = repair.overlay([a, b], lambda i: i[0] and not i[1])
    assert area(union) + area(common) == pytest.approx(area(a) + area(b), abs=0.2)
    assert area(rest) == pytest.approx(area(a) - area(common), abs=0.2)
    assert area(repair.overlay([union], any)) == pytest.approx(area(union), abs=0.2)


def test_validity_and_repair(spark):
    bow = [[ring((0, 0), (4, 4), (4, 0), (0, 4))]]
    short = [[ring((0, 0), (1, 0))]]
    twice = [[np.repeat(ring((0, 0), (0, 2), (2, 2), (2, 0)), 2, 0)]]
    assert repair.crosses_itself(bow)
    assert not repair.crosses_itself(box(0, 0, 1, 1))
    assert repair.crosses_itself([[ring((0, 0), (0, 4), (4, 4), (4, 0)), ring((2, 2), (2, 6), (3, 6))]])
    rows = [(0, box(0, 0, 2, 2)), (1, bow), (2, short), (3, twice), (4, None), (5, [])]
    df = spark.createDataFrame([(i, rows_of(g)) for i, g in rows], f"id int, g {G.GEOMETRY}")
    df = df.withColumn("r", repair.repaired(F.col("g"))).withColumns({"simple": repair.is_simple(F.col("g")), "fixed": repair.is_simple(F.col("r")), "a": G.area(F.col("r"))})
    got = {r.id: r for r in df.collect()}
    assert [got[i].simple for i in range(5)] == [True, False, False, False, None]
    assert [got[i].a for i in (0, 1, 3)] == pytest.approx([4, 8, 4])
    assert got[1].fixed and got[3].fixed
    assert got[2].r is None and got[4].r is None and got[5].r is None


def test_simplify(spark):
    line = [[ring((0, 0), (0, 2), (0, 4), (4, 4), (4, 0))]]
    df = spark.createDataFrame([(rows_of(line),)], f"g {G.GEOMETRY}")
    assert df.select(G.n_points(repair.simplified(F.col("g"))).alias("n")).head().n == 5


def test_wkb_round_trip(spark):
    many = [*box(0, 0, 1, 1), *box(5, 5, 7, 7)]
    big_endian = struct.pack(">BIII", 0, 3, 1, 4) + struct.pack(">8d", 0, 0, 0, 1, 1, 1, 0, 0)
    rows = [(0, box(0, 0, 1, 2)), (1, many), (2, None), (3, [])]
    df = spark.createDataFrame([(i, rows_of(g)) for i, g in rows], f"id int, g {G.GEOMETRY}").withColumn("b", wkb.to_wkb(F.col("g"))).withColumn("back", wkb.from_wkb(F.col("b")))
    got = {r.id: r for r in df.collect()}
    assert got[0].back == got[0].g and got[1].back == got[1].g
    assert got[2].b is None and got[3].b is None and got[2].back is None
    assert wkb.decode_one(big_endian)[0][0][2].tolist() == [1.0, 1.0]
    for bad in (b"", b"\x01", b"garbage", struct.pack("<BIdd", 1, 1, 0, 0), wkb.encode_one(many)[:-3]):
        assert wkb.decode_one(bad) is None
    spark.conf.set("spark.sql.geospatial.enabled", "true")


def test_difference_and_tiled_union(spark):
    df = spark.createDataFrame([(rows_of(box(0, 0, 4, 4)), rows_of(box(2, 2, 6, 6)))], f"a {G.GEOMETRY}, b {G.GEOMETRY}")
    assert df.select(G.area(repair.difference(F.col("a"), F.col("b"))).alias("x")).head().x == pytest.approx(12)
    layer = spark.createDataFrame([("k", rows_of(box(*b))) for b in ((0, 0, 4, 4), (2, 2, 6, 6), (1, 1, 3, 3))], f"c string, geometry {G.GEOMETRY}")
    for size in (3.0, 100.0):
        tiles = repair.union_in_tiles(layer, size, ["c"])
        assert tiles.agg(F.sum(G.area(F.col("geometry"))).alias("a")).head().a == pytest.approx(28)


def test_pipelines(spark):
    utm = [[ring((595970, 6401230), (595960, 6401230), (595960, 6401240), (595970, 6401240))]]
    df = spark.createDataFrame([(1, rows_of(utm)), (2, None)], f"id int, geometry {G.GEOMETRY}")
    out = repair.standard_pipeline(df).collect()
    assert [r.id for r in out] == [1] and out[0].srid == 4326
    p = out[0].geometry[0][0][0]
    assert (p.x, p.y) == pytest.approx((10.6121587, 57.74290978), abs=1e-7)
    degrees = [(1, wkb.encode_one([[[(q.x, q.y) for q in r] for r in p] for p in out[0].geometry])), (2, b"junk"), (3, None)]
    kept = repair.filtering_pipeline(spark.createDataFrame(degrees, "id int, geometry binary")).collect()
    assert [r.id for r in kept] == [1]
    assert kept[0].area_m2 == pytest.approx(100, abs=0.01)
    assert repair.filtering_pipeline(spark.createDataFrame(degrees, "id int, geometry binary"), max_area=50).count() == 0


@pytest.mark.parametrize("value", ["None", "[]"])
def test_batches_without_a_polygon_in_a_fresh_session(value):
    """A partition of nothing but null or nothing but empty geometries goes through every Python step."""
    code = f"""
from pyspark.sql import functions as F
from terraloom.functions import geometry as G, wkb
from terraloom.operators import repair
from terraloom.session import local_session, prepare
s = prepare(local_session(2, "fresh"))
df = s.createDataFrame([(i, {value}) for i in range(500)], f"id int, geometry {{G.GEOMETRY}}").repartition(2)
g = F.col("geometry")
out = df.select("id", repair.repaired(g).alias("r"), repair.simplified(g).alias("s"), repair.is_simple(g).alias("ok"), repair.difference(g, g).alias("d"), wkb.to_wkb(g).alias("b"), wkb.from_wkb(wkb.to_wkb(g)).alias("w")).collect()
assert len(out) == 500 and all(r.r is None and r.b is None and r.w is None for r in out)
assert repair.standard_pipeline(df).count() == 0 and repair.union_in_tiles(df.withColumn("k", F.lit(1)), 10.0, ["k"]).count() == 0
print("whole")
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=ROOT)
    assert done.stdout.strip().endswith("whole"), done.stderr[-3000:]
