"""Queries of source operators, over the given tables in the shape of landed responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions import geometry as G
from terraloom.operators import dedupe
from terraloom.plans.geometry_queries import _CELLS, cells
from terraloom.plans.registry import registry
from terraloom.session import prepare, read
from terraloom.sources import json_features, pages, text

QUERIES, ORACLES, query = registry()

_PLAN = "SELECT o_orderpriority AS layer, unnest(range(0, (count(*) + 999) // 1000)) AS page FROM orders GROUP BY 1"


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = read(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("layer")).agg(F.count("*").alias("total"))
    return pages.page_plan(totals, 1000)


@query(f"SELECT layer, page, page * 1000 AS page_offset FROM ({_PLAN})")
def page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).select("layer", "page", "page_offset")


@query(f"SELECT layer, page FROM ({_PLAN}) WHERE (layer, page) NOT IN (SELECT o_orderpriority, o_orderkey % 3 FROM orders WHERE o_orderkey % 3 < 2)")
def missing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("layer"), (F.col("o_orderkey") % 3).alias("page")).where("page < 2")
    return pages.missing_pages(_plan(spark, sf_dir), landed, ["layer", "page"]).select("layer", "page")


@query("""
    SELECT o_orderpriority AS layer, CASE WHEN o_orderpriority LIKE '1%' THEN 500 * 2000 ELSE count(*) END AS stated, count(*) FILTER (o_orderstatus <> 'P') AS parsed,
           CASE WHEN o_orderpriority LIKE '1%' THEN 500 * 2000 ELSE count(*) END - count(*) FILTER (o_orderstatus <> 'P') AS difference, FALSE AS suspect
    FROM orders GROUP BY 1""")
def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stated against parsed features; one layer states '*'."""
    orders = read(spark, sf_dir, "orders").withColumn("layer", F.col("o_orderpriority"))
    stated = orders.groupBy("layer").agg(F.count("*").cast("string").alias("n"))
    stated = stated.select("layer", pages.stated_total(F.when(F.col("layer").startswith("1"), "*").otherwise(F.col("n")), F.lit(500)).cast("bigint").alias("total"))
    return pages.reconcile(stated, orders.where("o_orderstatus <> 'P'"))


@query("""
    SELECT doc_id, entry, count(*) AS lines FROM (
      SELECT doc_id, n, sum(CAST(regexp_matches(line, '^[A-Z]') AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING)::BIGINT AS entry
      FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)))
    WHERE entry > 0 GROUP BY 1, 2""")
def text_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of texts to entries, which a line with a capital at its start opens."""
    lines = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    return text.entries(lines, "doc_id", "n", "line", F.col("line").rlike("^[A-Z]")).groupBy("doc_id", "entry").agg(F.count("*").alias("lines"))


@query("""
    SELECT event_type AS name, frequency, strftime(max(ts), '%Y-%m-%d') AS last_update, strftime(max(ts) + INTERVAL 7 DAY, '%Y-%m-%d') AS next_update
    FROM events JOIN (SELECT DISTINCT event_type, 'weekly' AS frequency FROM events WHERE event_type <> 'error') USING (event_type) GROUP BY 1, 2""")
def catalog_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enabled sources with their last and next update out of the run log."""
    from terraloom.functions.dates import iso_date, next_update

    log = read(spark, sf_dir, "events")
    catalog = log.select(F.col("event_type").alias("name")).distinct().withColumns({"enabled": F.col("name") != "error", "frequency": F.lit("weekly")}).where("enabled")
    runs = log.groupBy(F.col("event_type").alias("name")).agg(F.max_by("ts", "ts").alias("t"))
    joined = catalog.join(runs, "name", "left")
    return joined.select("name", "frequency", iso_date("t").alias("last_update"), iso_date(next_update(F.col("t"), F.col("frequency"))).alias("next_update"))


@query("SELECT event_type AS layer_name, CASE event_type WHEN 'click' THEN 'arcgis' ELSE 'wfs' END AS service, count(*) AS features FROM events WHERE event_type <> 'error' GROUP BY 1, 2")
def layer_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed rows to their layer's service; a layer that isn't in the manifest is passed over."""
    events = read(spark, sf_dir, "events").select(F.col("event_type").alias("layer_name"))
    manifest = events.distinct().where("layer_name <> 'error'").withColumn("service", F.when(F.col("layer_name") == "click", "arcgis").otherwise("wfs"))
    return events.join(manifest, "layer_name").groupBy("layer_name", "service").agg(F.count("*").alias("features"))


@query("SELECT max(doc_id) AS newest FROM documents WHERE n_chars = (SELECT max(n_chars) FROM documents)")
def newest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.col("n_chars").alias("modificationTime"))
    return pages.newest_file(files.withColumn("path", F.format_string("%012d", "path"))).select(F.col("path").cast("bigint").alias("newest"))


@query(f"SELECT id, gridcode, 100.0::DOUBLE AS area, 5 AS points, x::DOUBLE AS minx FROM ({_CELLS})")
def geojson_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells written as GeoJSON feature lines and read back."""
    lines = json_features.feature_lines(cells(spark, sf_dir))
    rings = f"array<{json_features.RINGS}>"
    back = lines.select(F.from_json("value", f"geometry struct<type:string,coordinates:{rings}>, properties struct<id:bigint,gridcode:int>").alias("f"))
    back = back.select("f.properties.*", F.transform("f.geometry.coordinates", json_features.rings_of).alias("g"))
    return back.select("id", "gridcode", G.area(F.col("g")).alias("area"), G.n_points(F.col("g")).alias("points"), G.bbox(F.col("g"))["minx"].alias("minx"))


@query(f"SELECT id, 1 AS polygons, 84.0::DOUBLE AS area FROM ({_CELLS}) WHERE gridcode = 12 UNION ALL SELECT id, 2, 116.0 FROM ({_CELLS}) WHERE gridcode <> 12")
def ring_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service rings by their turn: cells of code 12 have a hole, the others a second shell of 4 m."""
    g = cells(spark, sf_dir)
    o = F.get(G.points(F.col("geometry")), F.lit(0))
    inner = lambda dx, dy: [G.point(o["x"] + a, o["y"] + b) for a, b in ((dx, dy), (dx + 4, dy), (dx + 4, dy + 4), (dx, dy + 4), (dx, dy))]
    hole, part = F.array(*inner(3, 3)), F.array(*reversed(inner(13, 3)))
    rings = F.array(F.get(F.get(F.col("geometry"), F.lit(0)), F.lit(0)), F.when(F.col("gridcode") == 12, hole).otherwise(part))
    built = G.rings_by_turn(rings)
    return g.select("id", built.alias("g")).select("id", F.size("g").alias("polygons"), G.area(F.col("g")).alias("area"))


@query("SELECT url_host, count(*) AS pages, min(page_id) AS first_page FROM (SELECT *, regexp_extract(url, '://([^/]+)', 1) AS url_host FROM pages) GROUP BY 1")
def pages_by_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(prepare(spark), sf_dir, "pages").select("page_id", F.regexp_extract("url", "://([^/]+)", 1).alias("url_host"))
    return df.groupBy("url_host").agg(F.count("*").alias("pages"), F.min("page_id").alias("first_page"))


@query("""
    SELECT conv_id, count(*) AS turns, arg_max(role, turn) AS last_role, sum(length(text))::BIGINT AS chars FROM (
      SELECT DISTINCT ON (conv_id, turn) * FROM conversations ORDER BY conv_id, turn, role, text) GROUP BY 1""")
def conversation_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested records: turns once each, by conversation."""
    once = dedupe.first_seen(read(spark, sf_dir, "conversations"), ["conv_id", "turn"], ["role", "text"])
    return once.groupBy("conv_id").agg(F.count("*").alias("turns"), F.max_by("role", "turn").alias("last_role"), F.sum(F.char_length("text")).alias("chars"))
