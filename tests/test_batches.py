"""Many rows of geometries at once give what each gives by itself; work is dealt over the cores; bounds hold as tables grow."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terraloom.functions import crs
from terraloom.operators import covers, repair
from terraloom.operators.groups import whole_groups
from terraloom.plans import catalog
from terraloom.session import spread


def _shapes(n: int, seed: int) -> list:
    rng = np.random.default_rng(seed)
    rings = [np.round(rng.random((rng.integers(3, 9), 2)) * 12, 1) + [595000, 6401000] for _ in range(n)]
    return [[[np.concatenate([p, p[:1]])]] for p in rings] + [[], [[rings[0][:1]]]]


def _same(a: list, b: list) -> bool:
    return len(a) == len(b) and all(len(p) == len(q) and all(r.shape == s.shape and np.allclose(r, s, atol=1e-9) for r, s in zip(p, q, strict=True)) for p, q in zip(a, b, strict=True))


@pytest.mark.parametrize("few", [48, 7])
def test_overlays_together_are_those_alone(monkeypatch, few):
    monkeypatch.setattr(repair, "FEW", few)
    monkeypatch.setattr(repair, "TOGETHER", 500)
    a, b = _shapes(150, 1), _shapes(150, 2)[::-1]
    for keep in (all, lambda i: i[0] and not i[1]):
        got = repair.overlay_each(list(zip(a, b, strict=True)), keep)
        assert all(_same(g, repair.overlay([x, y], keep)) for g, x, y in zip(got, a, b, strict=True))
    assert repair.all_crossing(a) == [repair.crosses_itself(g) for g in a]
    assert repair.overlay_each([], all) == [] and repair.all_crossing([]) == []


def test_covers_together_are_those_alone():
    shapes = _shapes(80, 3) + [[[np.array([(x, -25), (x, 0), (x + 25, 0), (x + 25, -25), (x, -25)], float)]] for x in (-30, -25, 0, 3)]
    for size in (5.0, 25.0):
        for got, g in zip(covers.all_covers(shapes, size), shapes, strict=True):
            assert all(np.array_equal(x, y) for x, y in zip(got, covers.cover(g, size), strict=True))


def test_rows_of_a_small_table_are_dealt_over_the_cores(spark):
    assert spread(spark.range(1000).coalesce(1), "id").rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


@pytest.fixture(scope="module")
def grown(spark, tmp_path_factory):
    """Parts with keys as a table of 1.2 million has them."""
    path = tmp_path_factory.mktemp("grown")
    k = F.col("id") * 5987
    spark.range(200).select(k.alias("p_partkey"), F.lit(3).alias("p_size")).write.parquet(f"{path}/part.parquet")
    return str(path)


def test_shapes_of_a_grown_table_stay_on_the_registers_ground(spark, grown):
    rows = catalog.QUERIES["geometry_gate"](spark, grown).collect()
    assert rows and all(r.inside for r in rows)


def test_cells_of_a_grown_table_are_inside_the_zone(spark, grown):
    assert all(r.inside for r in catalog.QUERIES["utm_to_wgs84"](spark, grown).collect())


def test_a_register_keeps_its_own_bounds(spark):
    df = spark.createDataFrame([(595000.0, 6401000.0), (595000.0, 6641000.0)], "x double, y double")
    own, zone = crs.checked_point(F.col("x"), F.col("y")), crs.checked_point(F.col("x"), F.col("y"), *crs.ZONE)
    assert [tuple(r) for r in df.select(own.isNotNull(), zone.isNotNull()).collect()] == [(True, True), (False, True)]


def test_unions_of_many_tiles_together_are_those_alone(monkeypatch):
    """Groups of several geometries, groups without any, and scenes of more edges than are worked on together."""
    shapes = _shapes(240, 5)
    scenes = [[shapes[i : i + 1 + i % 5], [shapes[-3 - i]], shapes[i + 5 : i + 5 + i % 3]] for i in range(0, 200, 3)]
    scenes += [[[], [shapes[0]], []], [shapes[:90], [shapes[91]], shapes[92:95]]]
    keep = lambda i: i[0] and not i[2] or i[1] and i[2]
    want = [repair.overlay_groups(s, keep) for s in scenes]
    for tried in (1 << 18, 50):
        monkeypatch.setattr(repair, "TRIED", tried)
        assert all(_same(g, w) for g, w in zip(repair.overlay_groups_each(scenes, keep), want, strict=True))
    assert repair.overlay_groups_each([], keep) == []


@pytest.mark.parametrize("least", [1, 7, 10**6])
def test_small_groups_come_together_and_whole(spark, least):
    """Each call has whole groups, of `least` rows or more but for the last, wherever Arrow's batches end; few calls are made for many groups."""

    def work(rows, begins):
        k = rows["k"].to_pylist()
        assert begins == [i for i in range(len(k)) if not i or k[i] != k[i - 1]]
        return pa.table({"k": [k[b] for b in begins], "n": [j - i for i, j in zip(begins, [*begins[1:], len(k)], strict=True)], "calls": [int(not i) for i in range(len(begins))]}, schema=pa.schema([("k", pa.int64()), ("n", pa.int64()), ("calls", pa.int64())]))

    given = spark.range(600).select(F.when(F.col("id") % 40 > 0, F.floor(F.sqrt("id"))).alias("k"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 11)
    try:
        got = whole_groups(given, ["k"], work, "k long, n long, calls long", least).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.k is None, r.k or 0, r.n) for r in got) == sorted((r.k is None, r.k or 0, r["count"]) for r in given.groupBy("k").count().collect())
    calls = sum(r.calls for r in got)
    assert calls == len(got) if least == 1 else calls <= 600 / least + int(spark.conf.get("spark.sql.shuffle.partitions"))
