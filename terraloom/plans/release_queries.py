"""Queries of the star dissolve, of versioned publications, and of the catalog and the manifest of layers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.operators import catalog, covers, spatial, stars
from terraloom.plans.geometry_queries import _CELLS, cells
from terraloom.plans.overlay_queries import _square
from terraloom.plans.registry import registry
from terraloom.session import checkpointed, prepare, read, shared_dir
from terraloom.sinks import publish

QUERIES, ORACLES, query = registry()


@query(f"""
    WITH c AS MATERIALIZED (SELECT * FROM ({_CELLS}) WHERE gridcode IN (12, 60)),
    b AS (SELECT a.id, list(n.id) FILTER (n.id IS NOT NULL) AS below FROM c a
          LEFT JOIN c n ON n.id < a.id AND ((n.i = a.i AND n.j = a.j - 1) OR (n.i = a.i - 1 AND n.j = a.j)) GROUP BY 1),
    x AS (SELECT list({{'c': []::BIGINT[], 'id': id, 'below': coalesce(below, []::BIGINT[])}} ORDER BY id) AS l FROM b),
    r AS (SELECT list_reduce(list_prepend({{'c': []::BIGINT[], 'id': -1::BIGINT, 'below': []::BIGINT[]}}, l),
                 lambda a, x: {{'c': CASE WHEN list_has_any(a.c, x.below) THEN a.c ELSE list_append(a.c, x.id) END, 'id': x.id, 'below': x.below}}).c AS centres FROM x),
    k AS (SELECT unnest(centres) AS centre FROM r)
    SELECT b.id, coalesce(min(k.centre), b.id) AS centre, min(n.group_id) AS group_id
    FROM b LEFT JOIN k ON list_contains(b.below, k.centre) AND b.id NOT IN (SELECT centre FROM k)
    JOIN (SELECT centre, row_number() OVER (ORDER BY centre) AS group_id FROM k) n ON n.centre = coalesce((SELECT min(q.centre) FROM k q WHERE list_contains(b.below, q.centre)), b.id)
    GROUP BY b.id""")
def star_dissolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wetland cells in the order of their ids, each free one taking its free neighbours along an edge."""
    df = cells(spark, sf_dir).where("gridcode IN (12, 60)").withColumn("layer", F.lit(1))
    return stars.greedy_stars(df, spatial.edge_links(df, "id", "layer")).select("id", "centre", "group_id")


@query("""
    SELECT p_partkey AS id, p_partkey AS neighbour, ((10 - p_partkey % 7) * 10)::DOUBLE AS common FROM part UNION ALL SELECT p_partkey, -1, 100.0 FROM part""")
def cover_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares to those of another layer, and to one of a thousand kilometres that lies around all, by covers of cells of many sizes."""
    k = F.col("p_partkey")
    x, y = F.lit(595000.0) + 40 * (k % 50), F.lit(6401000.0) + 40 * F.floor(k / 50)
    parts = read(prepare(spark), sf_dir, "part")
    layer = lambda shift, name: parts.select(k.alias(name), F.array(F.array(_square(x + shift, y, 10))).alias("geometry"))
    wide = parts.select(F.array(F.array(_square(F.min(x) - 1000, F.min(y) - 1000, 1_000_000))).alias("geometry")).select(F.lit(-1).cast("long").alias("neighbour"), "geometry")
    return covers.cover_join(layer(F.lit(0), "id"), layer(k % 7, "neighbour").unionByName(wide), "id", "neighbour", 25.0).select("id", "neighbour", F.round("common", 6).alias("common"))


def _versions(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Orders published four times: urgent ones, none (which is no version), then those before 1998, then all."""
    root = f"{shared_dir(prepare(spark))}/versions-{uuid.uuid4().hex[:12]}"
    orders = read(spark, sf_dir, "orders")
    for part in (orders.where("o_orderpriority = '1-URGENT'"), orders.where("o_orderkey IS NULL"), orders.where("o_orderdate < '1998-01-01'"), orders):
        publish.publish_version(part, root, "orders")
    return root, orders


@query("SELECT o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def versioned_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current version, after several were published."""
    root, _ = _versions(spark, sf_dir)
    out = checkpointed(publish.read_current(spark, root, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")))
    publish.remove(spark, root)
    return out


@query("""
    SELECT 'orders' AS dataset, 1::BIGINT AS version, count(*) FILTER (o_orderpriority = '1-URGENT') AS rows FROM orders UNION ALL
    SELECT 'orders', 2, count(*) FILTER (o_orderdate < '1998-01-01') FROM orders UNION ALL SELECT 'orders', 3, count(*) FROM orders""")
def publication_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each publication, counted as they were written."""
    root, _ = _versions(spark, sf_dir)
    out = checkpointed(publish.run_log(spark, root, "orders").select("dataset", "version", "rows"))
    publish.remove(spark, root)
    return out


_LAYERS = ", ".join(f"({i}, '{name}', '{catalog.OTHER_SERVICES.get(name, ('fvm', 'wfs'))[0]}', '{catalog.OTHER_SERVICES.get(name, ('fvm', 'wfs'))[1]}')" for i, name in enumerate(catalog.WATER_LAYERS))


@query(f"""
    SELECT name AS layer_name, service, kind, count(*) AS features, sum(l_quantity) AS area FROM lineitem JOIN (VALUES {_LAYERS}) m(place, name, service, kind) ON place = l_partkey % 17 GROUP BY ALL""")
def water_layer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features to the service of their layer; of seventeen layers that lines are dealt to, three are not in the manifest."""
    names = F.array(*map(F.lit, [*catalog.WATER_LAYERS, "N2000_projekter:Hydrologi_F", "other", ""]))
    rows = read(prepare(spark), sf_dir, "lineitem").select(F.get(names, (F.col("l_partkey") % 17).cast("int")).alias("layer_name"), "l_quantity")
    return catalog.routed(rows, catalog.water_layers(spark)).groupBy("layer_name", "service", "kind").agg(F.count("*").alias("features"), F.sum("l_quantity").alias("area"))


@query("""
    SELECT c_name AS name, CASE c_custkey % 3 WHEN 0 THEN 'weekly' WHEN 1 THEN 'static' ELSE 'monthly' END AS frequency, strftime(max(o_orderdate), '%Y-%m-%d') AS last_update,
           CASE WHEN c_custkey % 3 = 0 THEN strftime(max(o_orderdate) + INTERVAL 7 DAY, '%Y-%m-%d') END AS next_update
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE c_custkey % 5 <> 0 GROUP BY c_custkey, c_name""")
def source_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enabled sources with their last run and when the next is due."""
    k = F.col("c_custkey")
    sources = read(prepare(spark), sf_dir, "customer").select(F.col("c_name").alias("name"), (k % 5 != 0).alias("enabled"), F.when(k % 3 == 0, "weekly").when(k % 3 == 1, "static").otherwise("monthly").alias("frequency"), k)
    runs = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").alias("at")).join(sources.select("c_custkey", "name"), "c_custkey")
    return catalog.freshness(sources, runs.select("name", "at"))


def _open_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON lines with nested parts, some of them absent, null or of another kind."""
    k = F.col("o_orderkey")
    price = F.when(k % 3 == 0, F.to_variant_object(F.array("o_totalprice"))).when(k % 3 == 1, F.to_variant_object(F.struct(F.col("o_totalprice").alias("amount"), (k % 2 == 0).alias("paid"))))
    row = F.struct(k.alias("id"), F.col("o_orderstatus").alias("status"), F.struct(F.array((k % 5).cast("string"), (k % 7).cast("string")).alias("codes"), price.alias("price")).alias("detail"))
    return read(prepare(spark), sf_dir, "orders").select(F.to_json(row).alias("value"))


@query("""
    SELECT '$' AS path, 'object' AS kind, count(*) AS n FROM orders UNION ALL SELECT '$.id', 'number', count(*) FROM orders UNION ALL SELECT '$.status', 'string', count(*) FROM orders UNION ALL
    SELECT '$.detail', 'object', count(*) FROM orders UNION ALL SELECT '$.detail.codes', 'array', count(*) FROM orders UNION ALL SELECT '$.detail.codes[*]', 'string', 2 * count(*) FROM orders UNION ALL
    SELECT '$.detail.price', CASE o_orderkey % 3 WHEN 0 THEN 'array' ELSE 'object' END, count(*) FROM orders WHERE o_orderkey % 3 < 2 GROUP BY 2 UNION ALL
    SELECT '$.detail.price[*]', 'number', count(*) FROM orders WHERE o_orderkey % 3 = 0 UNION ALL
    SELECT '$.detail.price.amount', 'number', count(*) FROM orders WHERE o_orderkey % 3 = 1 UNION ALL SELECT '$.detail.price.paid', 'boolean', count(*) FROM orders WHERE o_orderkey % 3 = 1""")
def nested_path_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each path of nested records has a value of each kind."""
    from terraloom.sources import inferred

    return inferred.path_profile(_open_records(spark, sf_dir))


@query("""
    SELECT o_orderkey AS id, o_orderstatus AS status, CAST(o_orderkey % 5 AS VARCHAR) AS first_code, CASE WHEN o_orderkey % 3 = 1 THEN round(o_totalprice, 2) END AS amount,
           CASE WHEN o_orderkey % 3 = 0 THEN round(o_totalprice, 2) END AS listed FROM orders""")
def inferred_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records read without a declared schema; what is of several kinds stays open and is read by its path."""
    from terraloom.sources import inferred

    path = f"{shared_dir(prepare(spark))}/landed-{uuid.uuid4().hex[:12]}"
    _open_records(spark, sf_dir).write.text(path)
    r = inferred.read_records(spark, path)
    amount = lambda at: F.round(F.try_variant_get("detail.price", at, "double"), 2)
    out = checkpointed(r.select("id", "status", F.get("detail.codes", F.lit(0)).alias("first_code"), amount("$.amount").alias("amount"), amount("$[0]").alias("listed")))
    publish.remove(spark, path)
    return out
