"""Queries of layers in Parquet with geometry metadata, of zipped JSON and of feature collections."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions import geometry as G
from terraloom.plans.geometry_queries import _CELLS, cells
from terraloom.plans.overlay_queries import _SHAPES, shapes
from terraloom.plans.registry import registry
from terraloom.session import checkpointed, prepare, read, shared_dir
from terraloom.sinks import geoparquet, publish
from terraloom.sources import json_features

QUERIES, ORACLES, query = registry()


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(prepare(spark))}/geo-{uuid.uuid4().hex[:12]}"


#: What shapes by their kind reach to, from their own corner.
_REACH = "CASE kind WHEN 0 THEN side WHEN 1 THEN 8 WHEN 2 THEN 10 WHEN 3 THEN 24 WHEN 6 THEN 6 END"
_UP = "CASE kind WHEN 0 THEN side WHEN 1 THEN 8 WHEN 2 THEN 10 WHEN 3 THEN 10 WHEN 6 THEN 6 END"


@query(f"""
    SELECT 'WKB' AS encoding, 'EPSG:25832' AS crs, 'MultiPolygon,Polygon' AS kinds, count(*) AS rows, min(x)  FILTER (kind NOT IN (4, 5)) AS xmin, min(y) FILTER (kind NOT IN (4, 5)) AS ymin,
           max(x + {_REACH}) AS xmax, max(y + {_UP}) AS ymax FROM ({_SHAPES})""")
def geo_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer's encoding, reference system, kinds, rows and bounds as the footers of its files state them."""
    path = _folder(spark)
    geoparquet.write_geo(shapes(spark, sf_dir).select("id", "geometry"), path, 25832)
    f = geoparquet.footers(spark, path)
    whole = f.groupBy("encoding", "crs").agg(
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("kinds")))), ",").alias("kinds"),
        F.sum("rows").alias("rows"), F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"),
    )
    out = checkpointed(whole)
    publish.remove(spark, path)
    return out


@query(f"""
    SELECT id, ({_REACH})::DOUBLE AS width, CASE kind WHEN 0 THEN side * side WHEN 1 THEN 0 WHEN 2 THEN 84 WHEN 3 THEN 116 WHEN 6 THEN 36 END::DOUBLE AS area
    FROM ({_SHAPES}) WHERE kind NOT IN (4, 5) AND x <= 595820 AND x + {_REACH} >= 595200""")
def geo_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes of a strip of the layer, read by their boxes."""
    path = _folder(spark)
    geoparquet.write_geo(shapes(spark, sf_dir).select("id", "geometry"), path, 25832)
    g = F.col("geometry")
    strip = geoparquet.read_geo(spark, path, (595200.0, 0.0, 595820.0, 1e9))
    box = G.bbox(g)
    out = checkpointed(strip.select("id", F.round(box["maxx"] - box["minx"], 6).alias("width"), F.round(G.area(g), 6).alias("area")))
    publish.remove(spark, path)
    return out


@query(f"SELECT id // 100 AS page, count(*) AS features, min(id) AS first_id, max(id) AS last_id, 'MultiPolygon' AS kind FROM ({_CELLS}) GROUP BY 1")
def feature_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells in collections of a hundred, read back by path."""
    pages = json_features.collections(cells(spark, sf_dir), 100, key="id")
    at = lambda i: F.get_json_object("value", f"$.features[{i}].properties.id").cast("long")
    ids = F.from_json(F.get_json_object("value", "$.features[*].properties.id"), "array<long>")
    return pages.select(
        "page",
        F.size(F.from_json("value", "type string, features array<struct<type:string>>")["features"]).cast("long").alias("features"),
        at(0).alias("first_id"),
        F.coalesce(F.element_at(ids, -1), at(0)).alias("last_id"),
        F.get_json_object("value", "$.features[0].geometry.type").alias("kind"),
    )


@query("""
    SELECT c_mktsegment AS batch, count(*) AS features, 1::BIGINT AS batches, count(*)::DOUBLE AS mean_features FROM customer GROUP BY 1
    UNION ALL SELECT NULL, count(*), count(DISTINCT c_mktsegment), round(count(*) / count(DISTINCT c_mktsegment), 6) FROM customer""")
def batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of each batch; and over all, how many batches there are and how many features one has on average."""
    each = read(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("batch")).agg(F.count("*").alias("features"))
    whole = each.agg(F.sum("features").alias("features"), F.count("*").alias("batches"))
    mean = F.round(F.col("features") / F.col("batches"), 6).alias("mean_features")
    return each.withColumn("batches", F.lit(1).cast("long")).select("batch", "features", "batches", mean).unionByName(whole.select(F.lit(None).cast("string").alias("batch"), "features", "batches", mean))


@query("""
    SELECT s_suppkey AS herd_number, s_nationkey % 4 AS species_code, min(CASE WHEN c_custkey % 6 <> 0 THEN c_custkey END) AS chr_number
    FROM supplier JOIN customer ON c_nationkey = s_nationkey GROUP BY 1, 2 HAVING min(CASE WHEN c_custkey % 6 <> 0 THEN c_custkey END) IS NOT NULL""")
def herd_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The holding of each herd and species; herds without one are dropped."""
    herds = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("herd_number"), (F.col("s_nationkey") % 4).alias("species_code"), F.col("s_nationkey").alias("place"))
    k = F.col("c_custkey")
    details = read(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("place")).agg(F.min(F.when(k % 6 != 0, k)).alias("chr_number"))
    return herd_to_holding(herds.select("herd_number", "species_code"), herds.join(details, "place").select("herd_number", "species_code", "chr_number"))


def herd_to_holding(herds: DataFrame, details: DataFrame) -> DataFrame:
    """(herd_number, species_code, chr_number): one row a herd and species, the smallest holding of several; null ones drop out before
    the shuffle."""
    known = details.where("chr_number IS NOT NULL").groupBy("herd_number", "species_code").agg(F.min("chr_number").alias("chr_number"))
    return herds.distinct().join(known, ["herd_number", "species_code"])
