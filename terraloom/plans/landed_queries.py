"""Queries of readers and publishers: the given tables are written as landed pages and files, and read or published by the library."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions import geometry as G
from terraloom.functions import wkb
from terraloom.functions.clean import clean_text, to_int
from terraloom.operators import formats, mapping, quality, spec
from terraloom.plans.geometry_queries import _CELLS, cells
from terraloom.plans.overlay_queries import _SHAPES, shapes
from terraloom.plans.registry import registry
from terraloom.session import checkpointed, prepare, read, shared_dir
from terraloom.sinks import publish as P
from terraloom.sources import json_features, sheets, text, wfs
from terraloom.streaming import ingest

QUERIES, ORACLES, query = registry()


def folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(prepare(spark))}/{name}-{uuid.uuid4().hex[:12]}"


def _positions(three: bool = False):
    """A cell's outer ring as a list of positions."""
    return F.array_join(F.transform(G.points(F.col("geometry")), lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"), *([F.lit("1.5")] if three else []))), " ")


def _xml_pages(spark: SparkSession, features: DataFrame, attributes: str = "") -> DataFrame:
    """Features (id, xml) as landed pages of 100, many pages a file."""
    path = folder(spark, "pages")
    page = F.concat(F.lit(f'<w:FeatureCollection xmlns:w="w" xmlns:n="n" xmlns:gml="g" {attributes}>'), F.array_join(F.array_sort(F.collect_list("xml")), ""), F.lit("</w:FeatureCollection>"))
    pages = features.groupBy(F.floor(F.col("id") / 100).alias("page")).agg(page.alias("value"))
    pages.select("value").write.option("lineSep", "\x01").text(path)
    # A page is one record of its file; records are parted by a sign that XML cannot hold.
    return spark.read.text(path, lineSep="\x01").where("value <> ''").select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("page_xml"))


_STATUS = "CASE id % 4 WHEN 0 THEN 'Frivillig aftale tilbudt (UDGÅET)' WHEN 1 THEN 'Indsats gennemført' WHEN 2 THEN 'Ny' END"


@query(f"""
    SELECT id, (id % 9)::BIGINT AS bfe_number, id % 2 = 0 AS is_worker_housing, CASE WHEN id % 3 <> 0 THEN 'e' || id END AS business_event, 96.0::DOUBLE AS area FROM ({_CELLS}) WHERE id % 9 <> 0 AND id % 5 <> 0""")
def cadastral_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parcels with a hole, in three dimensions; without a number or a geometry there is no row."""
    k = F.col("id")
    o = F.get(G.points(F.col("geometry")), F.lit(0))
    hole = F.array_join(F.array(*(F.concat_ws(" ", (o["x"] + a).cast("string"), (o["y"] + b).cast("string"), F.lit("0")) for a, b in ((2, 2), (4, 2), (4, 4), (2, 4), (2, 2)))), " ")
    shape = F.when(k % 5 != 0, F.concat(F.lit("<n:geometri><gml:MultiSurface><gml:surfaceMember><gml:Polygon><gml:exterior><gml:LinearRing><gml:posList>"), _positions(True), F.lit("</gml:posList></gml:LinearRing></gml:exterior><gml:interior><gml:LinearRing><gml:posList>"), hole, F.lit("</gml:posList></gml:LinearRing></gml:interior></gml:Polygon></gml:surfaceMember></gml:MultiSurface></n:geometri>")))
    xml = F.concat(
        F.lit('<n:SamletFastEjendom_Gaeldende gml:id="x"><n:BFEnummer> '), k % 9, F.lit("</n:BFEnummer><n:id_lokalId>"), k, F.lit("</n:id_lokalId><n:arbejderbolig>"), F.when(k % 2 == 0, "TRUE").otherwise("false"),
        F.lit("</n:arbejderbolig><n:forretningshaendelse>"), F.when(k % 3 != 0, F.concat(F.lit("e"), k)).otherwise("  "), F.lit("</n:forretningshaendelse>"), F.coalesce(shape, F.lit("")), F.lit("</n:SamletFastEjendom_Gaeldende>"),
    )
    out = wfs.cadastral(_xml_pages(spark, cells(spark, sf_dir).select("id", xml.alias("xml"))))
    return out.select(to_int(F.col("id_local")).alias("id"), "bfe_number", "is_worker_housing", "business_event", F.round(G.area(F.col("geometry")), 6).alias("area"))


@query(f"""
    SELECT id, 0.01::DOUBLE AS area_ha, {_STATUS} AS status_bnbo, CASE id % 4 WHEN 0 THEN 'Action Required' WHEN 1 THEN 'Completed' WHEN 2 THEN 'Unknown' END AS status_category, 'k' || id % 98 AS kommune FROM ({_CELLS}) WHERE id % 5 <> 0""")
def protection_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Protected areas with open fields, their status in categories; a feature without a geometry is no row."""
    k = F.col("id")
    status = F.when(k % 4 == 0, "Frivillig aftale tilbudt (UDGÅET)").when(k % 4 == 1, "Indsats gennemført").when(k % 4 == 2, "Ny").otherwise(" ")
    shape = F.when(k % 5 != 0, F.concat(F.lit("<n:Shape><gml:MultiSurface><gml:Polygon><gml:exterior><gml:posList>"), _positions(), F.lit("</gml:posList></gml:exterior></gml:Polygon></gml:MultiSurface></n:Shape>")))
    xml = F.concat(F.lit("<n:BNBO><n:Id>"), k, F.lit("</n:Id><n:Status_BNBO>"), status, F.lit("</n:Status_BNBO><n:Kommune> k"), k % 98, F.lit("</n:Kommune>"), F.coalesce(shape, F.lit("")), F.lit("</n:BNBO>"))
    out = wfs.protected_areas(_xml_pages(spark, cells(spark, sf_dir).select("id", xml.alias("xml"))), "BNBO")
    field = lambda n: F.try_element_at("fields", F.lit(n))
    return out.select(to_int(field("id")).alias("id"), F.round("area_ha", 6).alias("area_ha"), "status_bnbo", "status_category", field("kommune").alias("kommune"))


@query(f"SELECT id::VARCHAR AS id, gridcode::INTEGER AS gridcode, CASE WHEN gridcode = 12 THEN '6-12' END AS toerv_pct, 100.0::DOUBLE AS area FROM ({_CELLS}) WHERE id % 6 <> 0")
def wetland_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wetland cells; one with too short a ring is no row."""
    k = F.col("id")
    ring = F.when(k % 6 != 0, _positions()).otherwise("1 1 2 2")
    xml = F.concat(F.lit('<n:kulstof2022 gml:id="'), k, F.lit('"><n:gridcode>'), F.col("gridcode"), F.lit("</n:gridcode><n:toerv_pct>"), F.when(F.col("gridcode") == 12, "6-12").otherwise(" "), F.lit("</n:toerv_pct><gml:Polygon><gml:exterior><gml:posList>"), ring, F.lit("</gml:posList></gml:exterior></gml:Polygon></n:kulstof2022>"))
    out = wfs.wetland_cells(_xml_pages(spark, cells(spark, sf_dir).select("id", xml.alias("xml"))))
    return out.select("id", "gridcode", "toerv_pct", F.round(G.area(F.col("geometry")), 6).alias("area"))


@query(f"SELECT '*' AS matched, returned, count(*) AS pages FROM (SELECT 100::VARCHAR AS returned FROM ({_CELLS}) GROUP BY id // 100) GROUP BY ALL")
def page_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _xml_pages(spark, cells(spark, sf_dir).select("id", F.lit("<n:a/>").alias("xml")), 'numberMatched="*" numberReturned="100"')
    return wfs.page_totals(pages).groupBy("matched", "returned").agg(F.count("*").alias("pages"))


def _service_pages(spark: SparkSession, df: DataFrame, attributes) -> str:
    """Cells as service pages of 100: attributes and rings, without rings for every fifth."""
    path = folder(spark, "service")
    rings = F.transform(F.get("geometry", F.lit(0)), lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    feature = F.struct(attributes.alias("attributes"), F.struct(F.when(F.col("id") % 5 != 0, rings).alias("rings")).alias("geometry"))
    pages = df.groupBy(F.floor(F.col("id") / 100).alias("page")).agg(F.count("*").alias("count"), F.collect_list(feature).alias("features"))
    pages.select(F.to_json(F.struct("count", "features")).alias("value"), "page").repartition(16, "page").write.partitionBy("page").text(path)
    return f"{path}/page=*"


@query(f"SELECT id::VARCHAR AS field_id, CASE WHEN id % 3 = 0 THEN NULL ELSE (id * 0.5)::DOUBLE END AS area_ha, 'b' || id AS block_id, 'fields' AS dataset, 100.0::DOUBLE AS area FROM ({_CELLS}) WHERE id % 5 <> 0")
def field_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agricultural fields of service pages; the endpoint names the dataset."""
    k = F.col("id")
    attributes = F.struct(k.cast("string").alias("Marknr"), F.when(k % 3 == 0, "ukendt").otherwise((k * 0.5).cast("string")).alias("IMK_areal"), F.concat(F.lit("b"), k).alias("MB_NR"))
    out = json_features.endpoint(spark, _service_pages(spark, cells(spark, sf_dir), attributes), "fields")
    return out.select("field_id", "area_ha", "block_id", "dataset", F.round(G.area(F.col("geometry")), 6).alias("area"))


@query(f"SELECT id AS object_id, 'lag' AS layer_name, 'p' || id AS projektnavn, strftime(make_timestamp(id * 86400000000), '%Y-%m-%d') AS startdato, 0.01::DOUBLE AS area_ha FROM ({_CELLS}) WHERE id % 5 <> 0")
def water_service_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("id")
    attributes = F.struct(F.concat(F.lit("p"), k).alias("projektnavn"), (k * 86400000).alias("projektstart"), k.alias("OBJECTID"))
    out = json_features.water_features(spark, _service_pages(spark, cells(spark, sf_dir), attributes), "lag")
    return out.select("object_id", "layer_name", "projektnavn", F.date_format("startdato", "yyyy-MM-dd").alias("startdato"), F.round("area_ha", 6).alias("area_ha"))


@query(f"SELECT id, gridcode::INTEGER AS gridcode, CASE WHEN id % 4 <> 0 THEN 100.0::DOUBLE * (1 + id % 2) END AS area FROM ({_CELLS})")
def geojson_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collections of polygons, multipolygons and points; of points there is no geometry."""
    path, k = folder(spark, "geojson"), F.col("id")
    ring = F.transform(F.get(F.get("geometry", F.lit(0)), F.lit(0)), lambda p: F.array(p["x"], p["y"]))
    kind = F.when(k % 4 == 0, "Point").when(k % 2 == 0, "Polygon").otherwise("MultiPolygon")
    shape = F.when(k % 4 == 0, "[1, 2]").when(k % 2 == 0, F.to_json(F.array(ring))).otherwise(F.to_json(F.array(F.array(ring), F.array(ring))))
    feature = F.concat(F.lit('{"type": "Feature", "geometry": {"type": "'), kind, F.lit('", "coordinates": '), shape, F.lit('}, "properties": {"id": '), k, F.lit(', "gridcode": '), F.col("gridcode"), F.lit("}}"))
    page = F.concat(F.lit('{"type": "FeatureCollection", "features": ['), F.array_join(F.collect_list(feature), ", "), F.lit("]}"))
    cells(spark, sf_dir).groupBy(F.floor(k / 100).alias("page")).agg(page.alias("value")).repartition(16, "page").write.partitionBy("page").text(path)
    out = json_features.geojson_features(spark, f"{path}/page=*", "id:long,gridcode:int")
    return out.select("id", "gridcode", F.round(G.area(F.col("geometry")), 6).alias("area"))


@query("SELECT event_id, event_type FROM events WHERE event_id % 50 <> 0")
def json_line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of JSON lines; every fiftieth is broken and left out."""
    path = folder(spark, "lines")
    line = F.to_json(F.struct("event_id", "event_type", "props"))
    read(spark, sf_dir, "events").select(F.when(F.col("event_id") % 50 == 0, F.substring(line, 1, 12)).otherwise(line).alias("value")).write.text(path)
    return json_features.json_lines(spark, path, "event_id long, event_type string", bad_most=10_000_000)


@query("SELECT s_suppkey AS company, CASE s_suppkey % 4 WHEN 1 THEN 'ha' WHEN 2 THEN 'm2' WHEN 3 THEN 'stk' ELSE '' END AS unit, CASE WHEN s_suppkey % 2 = 0 THEN TRUE ELSE FALSE END AS none, (2020 + s_suppkey % 2) || '-' || (2021 + s_suppkey % 2) AS plan_year FROM supplier")
def sheet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly sheets as CSV files, units and flags by their codes, the plan year from the file's name."""
    path, k = folder(spark, "sheets"), F.col("s_suppkey")
    df = read(spark, sf_dir, "supplier").select(k.alias("firma"), F.when(k % 4 == 0, 9).otherwise(k % 4).alias("enhed"), F.lit(1).alias("dosis"), F.when(k % 2 == 0, "SAND").otherwise("FALSK").alias("ingen"), (k % 2).alias("odd"))
    for odd in (0, 1):
        df.where(F.col("odd") == odd).drop("odd").write.option("header", True).csv(f"{path}/plan_{2020 + odd}_{2021 + odd}")
    out = sheets.typed(sheets.sheets(spark, path, ["firma", "enhed", "dosis", "ingen"]), "enhed", "dosis", "ingen")
    return out.select(to_int(F.col("firma")).alias("company"), F.col("enhed").alias("unit"), F.col("ingen").alias("none"), "plan_year")


@query("SELECT s_suppkey % 1000 AS code, 'Afgrøde ' || s_name AS name, 'Omdrift' AS category FROM supplier WHERE s_suppkey % 1000 > 0")
def crop_code_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of crop codes out of text, some of whose entries run over two lines."""
    k = F.col("s_suppkey") % 1000
    name = F.concat(F.lit("Afgrøde "), F.col("s_name"))
    lines = F.when(k % 3 == 0, F.array(F.concat(k, F.lit(" Afgrøde")), F.concat(F.col("s_name"), F.lit(" Omdrift")))).otherwise(F.array(F.concat(k, F.lit(" "), name, F.lit(" Omdrift"))))
    head = F.array(F.lit("Preface"), F.lit("Afgrødekode Navn Engangskompensationskategori"))
    df = read(spark, sf_dir, "supplier").where(k > 0).select(F.col("s_suppkey").cast("string").alias("file"), F.posexplode(F.concat(head, lines)).alias("line", "text"))
    found = text.crop_codes(df)
    return found.toDF("code", "name", "category").select(F.col("code").cast("bigint").alias("code"), "name", "category")


@query(f"SELECT id AS wetland_id, 'over 12' AS carbon_content, 0.01::DOUBLE AS area_ha, 5::INTEGER AS points FROM ({_CELLS})")
def static_wetlands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A static layer as published by its owner, in Parquet with binary shapes."""
    path = folder(spark, "static")
    df = cells(spark, sf_dir).select(F.col("id").alias("OBJECTID"), F.lit("over 12").alias("Kulstof"), F.lit(0.01).alias("Areal_ha"), F.lit("x").alias("Other"), wkb.to_wkb(F.col("geometry")).alias("geometry"))
    df.write.parquet(path)
    return spec.static_wetlands(spark, path).select("wetland_id", "carbon_content", "area_ha", G.n_points(F.col("geometry")).alias("points"))


@query("SELECT 'current' AS name, count(*) AS rows FROM orders UNION ALL SELECT 'second', count(*) FILTER (o_orderstatus = 'F') FROM orders UNION ALL SELECT 'csv', count(*) FROM orders UNION ALL SELECT 'lines', count(*) FROM orders UNION ALL SELECT 'geo', 4326 UNION ALL SELECT 'refused', 0 UNION ALL SELECT 'table', count(*) FROM orders UNION ALL SELECT 'records', count(*) FROM orders")
def published_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each publisher leaves behind: current tables twice, staged and promoted pages, CSV, lines, a table, records, a sidecar."""
    import datetime as dt

    root, df = folder(spark, "published"), read(spark, sf_dir, "orders")
    counted = lambda name, found: found.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows")
    P.publish(df, root, "a")
    first = checkpointed(counted("current", spark.read.parquet(f"{root}/raw/a/current.parquet")))
    P.publish(df.where("o_orderstatus = 'F'"), root, "a")
    P.write_csv(df, f"{root}/csv")
    lines = P.write_lines(df, root, "orders", dt.datetime(2024, 1, 2))
    square = F.array(F.array(F.array(*(G.point(F.col("o_orderkey") + x, F.lit(y)) for x, y in ((0, 0), (0, 1), (1, 1), (1, 0), (0, 0))))))
    P.geo_publish(df.select("o_orderkey", wkb.to_wkb(square).alias("geometry")), f"{root}/geo", 4326)
    P.stage(df, root, "s")
    P.promote(spark, root, "s", spark.range(0))
    P.export_records(df, f"{root}/export", dt.datetime(2024, 1, 1))
    P.publish(df.limit(0), root, "none")
    stated = F.get_json_object("value", "$.columns.geometry.crs")
    parts = [
        first, counted("second", spark.read.parquet(f"{root}/raw/a/current.parquet")), counted("csv", spark.read.option("header", True).csv(f"{root}/csv")), counted("lines", spark.read.json(lines)),
        spark.read.text(f"{root}/geo_geo_metadata").select(F.lit("geo").alias("name"), F.split(stated, ":")[1].cast("long").alias("rows")),
        counted("refused", spark.read.schema(df.schema).parquet(*(f"{root}/raw/none/{n}" for n in P.listed(spark, f"{root}/raw/none")))) if P.listed(spark, f"{root}/raw/none") else counted("refused", spark.createDataFrame([], df.schema)),
        counted("table", spark.read.parquet(f"{root}/raw/s/current.parquet")), counted("records", spark.read.json(f"{root}/export/records")),
    ]
    out = checkpointed(mapping.union_all(parts))
    P.remove(spark, root)
    return out


@query(f"SELECT 'current' AS layer, count(*) AS features, count(*) AS readable FROM ({_SHAPES}) WHERE kind NOT IN (4, 5) UNION ALL SELECT 'dissolved_current', count(*), count(*) FROM ({_CELLS} WHERE p_partkey % 2 = 0)")
def published_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer through the gate, and its dissolved layer beside it."""
    root = folder(spark, "layers")
    formats.publish_checked(shapes(spark, sf_dir).select("id", "geometry"), root, "layer")
    formats.publish_dissolved(cells(spark, sf_dir).where("id % 2 = 0").select("geometry"), root, "layer")
    stats = lambda name: formats.input_stats(spark.read.parquet(f"{root}/raw/layer/{name}.parquet")).select(F.lit(name).alias("layer"), "features", "readable")
    return stats("current").unionByName(stats("dissolved_current"))


@query("SELECT 'rows' AS \"check\", TRUE AS ok UNION ALL SELECT 'columns', TRUE UNION ALL SELECT 'srid', TRUE UNION ALL SELECT 'keys', TRUE UNION ALL SELECT 'absent', FALSE UNION ALL SELECT 'srid_other', FALSE")
def block_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contracts of a step's output: rows, columns, reference system and map keys."""
    df = cells(spark, sf_dir).withColumns({"srid": F.lit(4326), "fields": F.create_map(F.lit("a"), F.lit("b"))})
    return quality.contracts(
        df,
        {
            "rows": quality.has_rows(),
            "columns": quality.has_columns(df, ["id", "gridcode", "geometry"]),
            "srid": quality.all_rows(F.col("srid") == 4326),
            "keys": quality.all_rows(F.map_contains_key("fields", "a")),
            "absent": quality.has_columns(df, ["bbox"]),
            "srid_other": quality.all_rows(F.col("srid") == 25832),
        },
    )


@query("SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price FROM orders WHERE o_orderkey % 10 <> 0")
def dataset_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared dataset: read, mapped, keys checked, first-seen rows, published and read again."""
    root = folder(spark, "spec")
    df = read(spark, sf_dir, "orders").withColumn("key", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderkey")))
    dataset = spec.Dataset(
        "orders", lambda s: df.unionAll(df), (("key", "id", lambda c: to_int(c.cast("string"))), ("o_orderstatus", "status", clean_text), ("o_totalprice", "price", lambda c: c.cast("double"))), ("id",), ("id", "status")
    )
    assert dataset.sync(spark, root)
    return spark.read.parquet(f"{root}/raw/orders/current.parquet")


@query("SELECT count(*) AS rows, count(DISTINCT event_id) AS ids, count(DISTINCT event_type) AS kinds FROM events")
def staged_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files to a working table by a stream, twice with nothing new, then promoted."""
    base = folder(spark, "staged")
    schema = read(spark, sf_dir, "events").schema
    run = lambda: ingest.ingest(spark, f"{sf_dir}/[e]vents.parquet", schema, f"{base}/raw/events/working.parquet", f"{base}/state", keys=["event_id"], late=("ts", "400 days"))
    run()
    run()
    P.promote(spark, base, "events", spark.range(0))
    return spark.read.parquet(f"{base}/raw/events/current.parquet").agg(F.count("*").alias("rows"), F.count_distinct("event_id").alias("ids"), F.count_distinct("event_type").alias("kinds"))
