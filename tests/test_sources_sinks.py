"""Landed files in, published datasets out."""

import datetime as dt
import json
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from terraloom.functions import geometry as G
from terraloom.sinks import publish as P
from terraloom.sources import json_features, pages, sheets, text, wfs
from terraloom.streaming import ingest

CADASTRAL = """<?xml version="1.0"?><wfs:FeatureCollection xmlns:wfs="w" xmlns:mat="m" xmlns:gml="g" numberMatched="{n}" numberReturned="3">
<wfs:member><mat:SamletFastEjendom_Gaeldende gml:id="a"><mat:BFEnummer> 12 </mat:BFEnummer><mat:arbejderbolig>TRUE</mat:arbejderbolig><mat:registreringFra>2020-01-02T03:04:05Z</mat:registreringFra>
<mat:geometri><gml:MultiSurface><gml:surfaceMember><gml:Polygon><gml:exterior><gml:LinearRing><gml:posList>0 0 1 0 4 1 4 4 1 4 0 1</gml:posList></gml:LinearRing></gml:exterior>
<gml:interior><gml:LinearRing><gml:posList>1 1 1 2 1 1 2 2 1 1 2 1</gml:posList></gml:LinearRing></gml:interior></gml:Polygon></gml:surfaceMember></gml:MultiSurface></mat:geometri></mat:SamletFastEjendom_Gaeldende></wfs:member>
<wfs:member><mat:SamletFastEjendom_Gaeldende gml:id="b"><mat:BFEnummer>0</mat:BFEnummer></mat:SamletFastEjendom_Gaeldende></wfs:member>
<wfs:member><mat:SamletFastEjendom_Gaeldende gml:id="c"><mat:BFEnummer>13</mat:BFEnummer></mat:SamletFastEjendom_Gaeldende></wfs:member></wfs:FeatureCollection>"""

WATER = """<x:C xmlns:x="x" xmlns:gml="g"><x:m><x:lag gml:id="1"><x:the_geom><gml:Polygon><gml:posList>0 0 0 100 100 100 100 0 0 0</gml:posList></gml:Polygon></x:the_geom>
<x:budget>1200 kr</x:budget><x:startaar>to</x:startaar><x:startdato>31-12-2020</x:startdato><x:Kommune>Aarhus</x:Kommune><x:note> </x:note></x:lag></x:m></x:C>"""

CELL = """<n:C xmlns:n="n" xmlns:gml="g"><n:kulstof2022 gml:id="k.1"><n:gridcode>12</n:gridcode><n:toerv_pct>6-12</n:toerv_pct><gml:Polygon><gml:posList>0 0 0 10 10 10 10 0 0 0</gml:posList></gml:Polygon></n:kulstof2022></n:C>"""


def write(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content, encoding="utf-8")
    return str(path)


def test_cadastral_pages(spark, tmp_path):
    found = wfs.landed_pages(spark, write(tmp_path / "p.xml", CADASTRAL.format(n="*")))
    r = wfs.cadastral(found).collect()
    assert [x.bfe_number for x in r] == [12]
    assert r[0].is_worker_housing is True and r[0].registration_from is not None
    assert [len(p) for p in r[0].geometry] == [2]
    assert wfs.cadastral(found).select(G.area(F.col("geometry")).alias("a")).head().a == pytest.approx(15)
    t = wfs.page_totals(found).head()
    assert (t.matched, t.returned) == ("*", "3")


def test_water_and_wetland_pages(spark, tmp_path):
    r = wfs.water_projects(wfs.landed_pages(spark, write(tmp_path / "w.xml", WATER)), "lag").head()
    assert (r.layer_name, r.budget, r.startaar, r.area_ha) == ("lag", 1200.0, None, 1.0)
    assert r.startdato.date() == dt.date(2020, 12, 31)
    assert r.fields["kommune"] == "Aarhus" and "note" not in r.fields and "poslist" not in r.fields
    c = wfs.wetland_cells(wfs.landed_pages(spark, write(tmp_path / "c.xml", CELL))).head()
    assert (c.id, c.gridcode, c.toerv_pct) == ("k.1", 12, "6-12")


def test_declared_features(spark, tmp_path):
    path = write(tmp_path / "f.xml", "<root><row><a>1</a><b>x</b></row><row><a>2</a></row></root>")
    assert [tuple(r) for r in wfs.features(spark, path, "row", "a int, b string").orderBy("a").collect()] == [(1, "x"), (2, None)]


def test_service_pages(spark, tmp_path):
    shell, hole, other = [[0, 0], [0, 9], [9, 9], [9, 0], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]], [[20, 0], [20, 1], [21, 1], [21, 0], [20, 0]]
    page = {"count": 2, "features": [{"attributes": {"Marknr": "7", "IMK_areal": "1.5", "MB_NR": "b"}, "geometry": {"rings": [shell, hole, other]}}, {"attributes": {"Marknr": "8"}, "geometry": None}]}
    r = json_features.agricultural_fields(spark, write(tmp_path / "f.json", json.dumps(page))).head()
    assert (r.field_id, r.area_ha, r.block_id, r.srid) == ("7", 1.5, "b", 25832)
    assert sorted(len(p) for p in r.geometry) == [1, 2]
    water = {"features": [{"attributes": {"projektnavn": "p", "projektstart": 86400000, "projektslut": None, "OBJECTID": 5}, "geometry": {"rings": [shell]}}]}
    w = json_features.water_features(spark, write(tmp_path / "w.json", json.dumps(water)), "lag")
    assert w.select(F.date_format("startdato", "yyyy-MM-dd").alias("d"), "slutdato", "object_id").head() == ("1970-01-02", None, 5)


def test_geojson_and_records(spark, tmp_path):
    square = [[[0, 0], [0, 1], [1, 1], [1, 0], [0, 0]]]
    fc = {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": square}, "properties": {"gridcode": 12}}, {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [square, square]}, "properties": {"gridcode": 60}}, {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {"gridcode": 0}}]}
    got = json_features.geojson_features(spark, write(tmp_path / "g.json", json.dumps(fc)), "gridcode:int").orderBy("pos").collect()
    assert [(r.gridcode, r.geometry and len(r.geometry)) for r in got] == [(12, 1), (60, 2), (0, None)]
    lines = write(tmp_path / "l.ndjson", '{"a": 1, "z": 2}\nnot json\n\n{"a": 3}\n')
    assert sorted(r.a for r in json_features.json_lines(spark, lines, "a long").collect()) == [1, 3]
    with pytest.raises(ValueError, match="bad records"):
        json_features.json_lines(spark, lines, "a long", bad_most=0)
    with zipfile.ZipFile(tmp_path / "o.zip", "w") as z:
        z.writestr("read.txt", "no")
        z.writestr("o.json", json.dumps({"features": [{"type": "Feature", "properties": {"list": [1, 2], "deep": {"x": {"y": 1}}}, "geometry": {}}]}))
    v = json_features.zipped_records(spark, str(tmp_path / "o.zip")).head().value
    assert json.loads(v) == {"type": "Feature", "properties": {"list": [1, 2], "deep": {"x": {"y": 1}}}}


def test_crop_codes(spark):
    lines = ["Preface 1", "Afgrødekode Navn Engangskompensationskategori", "1 Vårbyg Omdrift", "2 Vinterhvede med", "langt navn Omdrift", "Miljøstyrelsen", "3 Uden kategori", "10 Vedvarende Permanent græs", "* Stjernemarkering"]
    df = spark.createDataFrame([("f", i, t) for i, t in enumerate(lines)], "file string, line int, text string")
    got = [tuple(r) for r in text.crop_codes(df).collect()]
    assert got == [(1, "Vårbyg", "Omdrift"), (2, "Vinterhvede med langt navn", "Omdrift"), (10, "Vedvarende Permanent", "græs")]


def test_sheets(spark, tmp_path):
    write(tmp_path / "s" / "plan_2021_2022.csv", "firma,enhed,dosis,ingen\nA,1,2,SAND\nB,9,,x\n")
    df = sheets.typed(sheets.sheets(spark, str(tmp_path / "s"), ["firma", "enhed", "dosis", "ingen"]), "enhed", "dosis", "ingen")
    got = {r.firma: r for r in df.collect()}
    assert (got["A"].enhed, got["A"].dosis, got["A"].ingen, got["A"].plan_year) == ("ha", "kg", True, "2021-2022")
    assert (got["B"].enhed, got["B"].dosis, got["B"].ingen) == ("", "", None)
    with pytest.raises(ValueError, match="missing columns"):
        sheets.sheets(spark, str(tmp_path / "s"), ["firma", "cvr"])


def test_page_planning(spark):
    plan = pages.page_plan(spark.createDataFrame([("a", 2500), ("b", 1000)], "layer string, total long"), 1000)
    assert sorted((r.layer, r.page, r.page_offset) for r in plan.collect()) == [("a", 0, 0), ("a", 1, 1000), ("a", 2, 2000), ("b", 0, 0)]
    with pytest.raises(PySparkException, match="no features"):
        pages.page_plan(spark.createDataFrame([("a", 0)], "layer string, total long"), 10).collect()
    with pytest.raises(PySparkException, match="bad total"):
        spark.range(1).select(pages.stated_total(F.lit("many"), F.lit(1))).collect()
    with pytest.raises(PySparkException, match="no landed file"):
        pages.newest_file(spark.createDataFrame([], "path string, modificationTime timestamp")).collect()


def test_publish(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(3).withColumn("b", F.lit("x"))
    assert P.publish(df, root, "d") and not P.publish(df.limit(0), root, "e")
    assert P.publish(spark.range(5), root, "d")
    assert spark.read.parquet(f"{root}/raw/d/current.parquet").count() == 5
    assert P.publish_all({"x": df, "y": df.limit(0)}, root) == {"x": True, "y": False}
    P.stage(df, root, "s")
    P.stage(df, root, "s")
    assert not P.promote(spark, root, "s", spark.range(1))
    assert P.promote(spark, root, "s", spark.range(0))
    assert spark.read.parquet(f"{root}/raw/s/current.parquet").count() == 6
    assert not P.exists(spark, f"{root}/raw/s/working.parquet")
    P.geo_publish(df, f"{root}/geo", 4326)
    assert P.geo_srid(spark, f"{root}/geo") == "EPSG:4326"
    assert P.write_lines(df, root, "owners", dt.datetime(2024, 1, 2, 3, 4, 5)).endswith("owners_20240102_030405.ndjson")
    P.write_csv(df, f"{root}/csv")
    assert '"0","x"' in "".join(p.read_text() for p in (tmp_path / "csv").glob("*.csv"))
    P.export_records(df, f"{root}/export", dt.datetime(2024, 1, 1))
    assert spark.read.json(f"{root}/export/metadata").head().next_update.startswith("2024-01-08")


def test_incremental_runs(spark, tmp_path):
    schema = "k long, v long"
    write_page = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "landed"))
    run = lambda **kw: ingest.ingest(spark, str(tmp_path / "landed"), spark.createDataFrame([], schema).schema, str(tmp_path / f"t{len(kw)}"), str(tmp_path / f"s{len(kw)}"), **kw)
    write_page([(1, 1), (2, 2)])
    assert run().count() == 2 and run(keys=["k"]).count() == 2
    write_page([(1, 9), (3, 3)])
    assert run().count() == 4 and run(keys=["k"]).count() == 3
    assert run().count() == 4
    ingest.log_run(spark, str(tmp_path / "runs"), "a", "success", 3)
    ingest.log_run(spark, str(tmp_path / "runs"), "b", "failed", 1)
    got = {r.source: (r.rows, r.success) for r in ingest.run_totals(spark.read.parquet(str(tmp_path / "runs"))).collect()}
    assert got == {"a": (3, True), "b": (1, False), None: (4, False)}


def test_replacing_a_table_never_loses_the_last_good_one(spark, tmp_path, monkeypatch):
    from terraloom.sinks import publish as P

    target = f"{tmp_path}/t.parquet"
    spark.range(3).write.parquet(target)
    spark.range(5).write.parquet(f"{tmp_path}/new")
    with pytest.raises(FileNotFoundError):
        P.replace_dir(spark, f"{tmp_path}/none", target)
    real = P._rename
    monkeypatch.setattr(P, "_rename", lambda fs, a, b: real(fs, a, b) if "new" not in str(a) else (_ for _ in ()).throw(OSError("refused")))
    with pytest.raises(OSError):
        P.replace_dir(spark, f"{tmp_path}/new", target)
    assert spark.read.parquet(target).count() == 3
    monkeypatch.undo()
    P.replace_dir(spark, f"{tmp_path}/new", target)
    assert spark.read.parquet(target).count() == 5 and not P.exists(spark, f"{target}.old")


def test_no_machine_local_folder_on_a_cluster(spark):
    from types import SimpleNamespace

    from terraloom.session import shared_dir

    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = lambda master, folder: SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: folder))
    with pytest.raises(ValueError):
        shared_dir(context("spark://host:7077", None))
    with pytest.raises(ValueError):
        shared_dir(context("local-cluster[2,1,1024]", None))
    assert shared_dir(context("spark://host:7077", "hdfs://own/folder")) == "hdfs://own/folder"


def test_a_broken_feature_does_not_stop_its_page(spark):
    """Fields are cut out by their tags, and a feature is parsed only where that may not be their text."""
    shape = "<n:geometri><gml:Polygon><gml:exterior><gml:posList>0 0 0 0 4 0 4 4 0 0 0 0</gml:posList></gml:exterior></gml:Polygon></n:geometri>"
    bodies = [
        "<n:BFEnummer>1</n:BFEnummer><n:forretningshaendelse>a</n:forretningshaendelse><n:open>",
        '<n:ind><n:BFEnummer a="x">2</n:BFEnummer></n:ind><n:forretningshaendelse>A &amp; B</n:forretningshaendelse>',
        "<n:BFEnummer>3</n:BFEnummer><n:forretningshaendelse><![CDATA[c<d]]></n:forretningshaendelse>",
        "<n:BFEnummer>4</n:BFEnummer><n:forretningshaendelse/><n:forretningshaendelse>late</n:forretningshaendelse>",
        "<n:BFEnummer>5</n:BFEnummer><!-- <n:forretningshaendelse>no</n:forretningshaendelse> -->",
        "<n:BFEnummer>6</n:BFEnummer><n:forretningshaendelse><n:x>e</n:x>f</n:forretningshaendelse>",
    ]
    page = "".join(f"<n:SamletFastEjendom_Gaeldende>{b}{shape}</n:SamletFastEjendom_Gaeldende>" for b in bodies)
    out = wfs.cadastral(spark.createDataFrame([("p", f"<w:FeatureCollection>{page}</w:FeatureCollection>")], "path string, page_xml string"))
    assert sorted(map(tuple, out.select("bfe_number", "business_event").collect())) == [(1, "a"), (2, "A & B"), (3, "c<d"), (4, None), (5, None), (6, "ef")]
