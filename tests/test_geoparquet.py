"""Layers with metadata in their footers; JSON in pieces; collections; sheets."""

import gzip
import io
import json
import random
import tracemalloc
import zipfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from terraloom.functions import geometry as G
from terraloom.sinks import geoparquet
from terraloom.sources import json_features, sheets
from terraloom.sources.json_stream import items


def squares(spark, n, parts=4):
    x = F.col("id").cast("double")
    ring = F.array(*(G.point(x * 10 + a, F.lit(float(b))) for a, b in ((0, 0), (0, 5), (5, 5), (5, 0), (0, 0))))
    shape = F.when(F.col("id") % 5 == 4, F.lit(None)).when(F.col("id") % 2 == 0, F.array(F.array(ring))).otherwise(F.array(F.array(ring), F.array(ring)))
    return spark.range(0, n, 1, parts).select("id", shape.alias("geometry"))


def test_footers_state_the_layer(spark, tmp_path):
    path = f"{tmp_path}/layer"
    assert geoparquet.write_geo(squares(spark, 100), path, 25832) == 100
    geo = [json.loads(pq.read_metadata(f).metadata[b"geo"]) for f in (tmp_path / "layer").glob("*.parquet")]
    assert len(geo) == 4 and {g["primary_column"] for g in geo} == {"geometry"}
    assert all(g["columns"]["geometry"]["encoding"] == "WKB" and g["columns"]["geometry"]["geometry_types"] == ["MultiPolygon", "Polygon"] for g in geo)
    assert sorted(g["columns"]["geometry"]["bbox"] for g in geo)[0] == [0.0, 0.0, 235.0, 5.0]
    assert pq.ParquetFile(next((tmp_path / "layer").glob("*.parquet"))).metadata.row_group(0).column(0).compression == "SNAPPY"
    f = geoparquet.footers(spark, path).agg(F.sum("rows").alias("n"), F.min("xmin").alias("a"), F.max("xmax").alias("b"), F.collect_set("crs").alias("crs")).head()
    assert (f.n, f.a, f.b, f.crs) == (100, 0.0, 985.0, ["EPSG:25832"])
    geoparquet.check_srid(spark, path, 25832)
    with pytest.raises(ValueError, match="not in EPSG:4326"):
        geoparquet.check_srid(spark, path, 4326)
    assert not [p for p in (tmp_path / "layer").iterdir() if p.name.startswith("_staging")]


def test_layers_read_back_whole_and_by_window(spark, tmp_path):
    path, df = f"{tmp_path}/layer", squares(spark, 100)
    geoparquet.write_geo(df, path, 4326)
    assert sorted(geoparquet.read_geo(spark, path).collect()) == sorted(df.collect(), key=lambda r: r.id)
    got = sorted(r.id for r in geoparquet.read_geo(spark, path, (100.0, 0.0, 200.0, 1.0)).collect())
    assert got == [i for i in range(100) if i % 5 != 4 and i * 10 <= 200 and i * 10 + 5 >= 100]
    plan = geoparquet.read_geo(spark, path, (100.0, 0.0, 200.0, 1.0))._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "LessThanOrEqual(bbox.xmin,200.0)" in plan


def test_a_table_is_replaced_and_an_empty_one_is_not_published(spark, tmp_path):
    path = f"{tmp_path}/layer"
    assert geoparquet.write_geo(squares(spark, 10).withColumn("bbox", F.lit("mine")), path, 4326) == 10
    assert geoparquet.footers(spark, path).select("covering").distinct().head().covering == "_bbox"
    assert {r.bbox for r in geoparquet.read_geo(spark, path, box="_bbox").collect()} == {"mine"}
    assert geoparquet.write_geo(squares(spark, 10).limit(0), path, 4326) == 0
    assert spark.read.parquet(path).count() == 10
    assert geoparquet.write_geo(squares(spark, 7), path, 4326) == 7 and spark.read.parquet(path).count() == 7
    assert geoparquet.write_geo(squares(spark, 10).where("id = 4"), path, 4326) == 1
    assert geoparquet.footers(spark, path).select("kinds", "xmin").head() == ([], None)


def test_tasks_that_fail_leave_nothing(spark, tmp_path):
    path = f"{tmp_path}/layer"
    bad = squares(spark, 50).withColumn("n", F.when(F.col("id") == 49, F.raise_error(F.lit("stop"))).otherwise(1))
    with pytest.raises(Exception, match="stop"):
        geoparquet.write_geo(bad, path, 4326)
    assert not list(tmp_path.rglob("*.parquet"))


def cut(data: bytes, size: int):
    return [data[i : i + size] for i in range(0, len(data), size)]


def random_value(rng, depth=0):
    kind = rng.randrange(8 if depth < 4 else 5)
    if kind < 5:
        return [None, True, rng.randrange(-99, 99), rng.random(), "".join(rng.choice('"\\{}[],:æ€\n features') for _ in range(rng.randrange(9)))][kind]
    if kind == 5:
        return [random_value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["features", "a", '"b', "ü\\"]) + str(i) * rng.randrange(2): random_value(rng, depth + 1) for i in range(rng.randrange(4))}


def test_items_of_pieces_of_any_size():
    rng = random.Random(3)
    for _ in range(300):
        found = [random_value(rng, 1) for _ in range(rng.randrange(6))]
        whole = {"type": "features", "x": random_value(rng), "features": found, "more": {"features": [{"not": 1}]}, "end": rng.choice([1, "}", []])}
        text = json.dumps(whole, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 2])).encode()
        want = [v for v in found if isinstance(v, dict)]
        for size in (1, 3, 17, len(text)):
            assert [json.loads(i) for i in items(cut(b"\xef\xbb\xbf" * (size > 3) + text, size), "features")] == want


@pytest.mark.parametrize("text", ['{"features": [{"a": 1}', '{"features": [{"a": "x', '{"features": [{"a": 1}]]', '{"a'])
def test_broken_documents_are_errors(text):
    with pytest.raises(ValueError):
        list(items(cut(text.encode(), 4), "features"))


def test_documents_without_features():
    for text in ("", " ", "[]", '[{"features": [{}]}]', '{"features": {"a": [{}]}}', '{"features": null}', '"features"', "7"):
        assert list(items([text.encode()], "features")) == []


def test_a_large_member_in_little_memory(spark, tmp_path):
    feature = json.dumps({"type": "Feature", "geometry": {"coordinates": [[i / 7, i / 3] for i in range(3000)]}, "properties": {"n": [1, 2]}}).encode()
    n = 800
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z, z.open("o.json", "w") as out:
        out.write(b'{"type": "FeatureCollection", "features": [')
        for i in range(n):
            out.write((b"," if i else b"") + feature)
        out.write(b"]}")
    tracemalloc.start()
    with zipfile.ZipFile(packed) as z, z.open("o.json") as member:
        assert sum(1 for _ in items(iter(lambda: member.read(1 << 20), b""), "features")) == n
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(feature) * n > 80_000_000 and peak < 10_000_000
    (tmp_path / "o.zip").write_bytes(packed.getvalue())
    with zipfile.ZipFile(tmp_path / "none.zip", "w") as z:
        z.writestr("x.txt", "no")
    got = json_features.zipped_records(spark, str(tmp_path)).groupBy("value").count().collect()
    assert [(json.loads(r.value), r["count"]) for r in got] == [({"type": "Feature", "properties": {"n": [1, 2]}}, n)]


def test_collections(spark):
    df = squares(spark, 25)
    pages = {r.page: json.loads(r.value) for r in json_features.collections(df, 10, key="id").collect()}
    assert {p: [f["properties"]["id"] for f in v["features"]] for p, v in pages.items()} == {0: list(range(10)), 1: list(range(10, 20)), 2: list(range(20, 25))}
    assert all(v["type"] == "FeatureCollection" for v in pages.values())
    assert sum(len(json.loads(r.value)["features"]) for r in json_features.collections(df, 4).collect()) == 25
    assert json_features.collections(df.limit(0), 4).count() == 0


def test_sheets_by_their_own_headers(spark, tmp_path):
    (tmp_path / "plan_2020_2021.csv").write_text("a,b\n1,2\n")
    (tmp_path / "plan_2021_2022").mkdir()
    (tmp_path / "plan_2021_2022/part-0.csv").write_text("b,z,a\n4,9,3\n")
    whole = gzip.compress(b"a,b\n5,6\n" * 1000)
    (tmp_path / "plan_2022_2023.csv.gz").write_bytes(whole[:15])
    got = sorted(tuple(r) for r in sheets.sheets(spark, str(tmp_path), ["a", "b"]).collect())
    assert got == [("1", "2", "plan_2020_2021.csv", "2020-2021"), ("3", "4", "plan_2021_2022", "2021-2022")]
    with pytest.raises(ValueError, match="missing columns"):
        sheets.sheets(spark, str(tmp_path), ["a", "z"])
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        sheets.sheets(spark, str(tmp_path / "none"), ["a"])
