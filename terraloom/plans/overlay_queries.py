"""Queries of validity, repair, codecs, overlay and dissolve, on shapes that vary with the keys of `part`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions import crs
from terraloom.functions import geometry as G
from terraloom.functions import wkb
from terraloom.operators import formats, repair, spatial
from terraloom.plans.registry import registry
from terraloom.session import prepare, read, spread

QUERIES, ORACLES, query = registry()


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of `part`, dealt over all cores: the table has few bytes, but its shapes much work."""
    return spread(read(prepare(spark), sf_dir, "part").select("p_partkey"), "p_partkey")


#: Shapes stand 40 m apart, 50 to a row.
_AT = "p_partkey AS id, p_partkey % 7 AS kind, 10 + p_partkey % 3 AS side, 595000.0 + 40 * (p_partkey % 50) AS x, 6401000.0 + 40 * (p_partkey // 50) AS y"
_SHAPES = f"SELECT {_AT} FROM part"


def _ring(x: Column, y: Column, *corners) -> Column:
    return F.array(*(G.point(x + a, y + b) for a, b in (*corners, corners[0])))


def _square(x: Column, y: Column, side, turn: bool = False) -> Column:
    corners = ((0, 0), (0, side), (side, side), (side, 0))
    return _ring(x, y, *(corners[::-1] if turn else corners))


#: Rows of shapes that are within the register's bounds, 58 degrees north.
_GROUND = 600


def shapes(spark: SparkSession, sf_dir: str, on_ground: bool = False) -> DataFrame:
    """(id, kind, geometry) of each part: 0 a square of 10 to 12 m, 1 a bow tie, 2 a square with a hole, 3 two squares,
    4 null, 5 empty, 6 a square with each point twice. With `on_ground` rows begin again in the south when they come to the
    register's northern bound, so that a larger table has more features on the same ground and none beyond the country."""
    k = F.col("p_partkey")
    row = F.floor(k / 50)
    x, y = F.lit(595000.0) + 40 * (k % 50), F.lit(6401000.0) + 40 * (row % _GROUND if on_ground else row)
    one = lambda *rings: F.array(F.array(*rings))
    six = _square(x, y, 6)
    made = (
        F.when(k % 7 == 0, one(_square(x, y, 10 + k % 3)))
        .when(k % 7 == 1, one(_ring(x, y, (0, 0), (8, 8), (8, 0), (0, 8))))
        .when(k % 7 == 2, one(_square(x, y, 10), _square(x + 3, y + 3, 4, True)))
        .when(k % 7 == 3, F.array(F.array(_square(x, y, 10)), F.array(_square(x + 20, y, 4))))
        .when(k % 7 == 5, F.array().cast(G.GEOMETRY))
        .when(k % 7 == 6, one(F.flatten(F.transform(six, lambda p: F.array(p, p)))))
    )
    return _parts(spark, sf_dir).select(k.alias("id"), (k % 7).alias("kind"), made.alias("geometry"))


_AREA = "(CASE kind WHEN 0 THEN side * side WHEN 1 THEN 32 WHEN 2 THEN 84 WHEN 3 THEN 116 WHEN 6 THEN 36 END)::DOUBLE"


@query(f"SELECT id, CASE WHEN kind IN (1, 6) THEN FALSE WHEN kind <> 4 THEN TRUE END AS simple FROM ({_SHAPES})")
def shape_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes(spark, sf_dir).select("id", repair.is_simple(F.col("geometry")).alias("simple"))


@query(f"SELECT id, {_AREA} AS area, (CASE WHEN kind IN (1, 3) THEN 2 WHEN kind IN (0, 2, 6) THEN 1 END)::INTEGER AS parts, CASE WHEN kind NOT IN (4, 5) THEN TRUE END AS simple FROM ({_SHAPES})")
def shape_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repaired shapes are simple and keep their even-odd area; null and empty ones are null."""
    df = shapes(spark, sf_dir).select("id", repair.repaired(F.col("geometry")).alias("g"))
    return df.select("id", F.round(G.area(F.col("g")), 6).alias("area"), F.when(F.col("g").isNotNull(), F.size("g")).alias("parts"), repair.is_simple(F.col("g")).alias("simple"))


@query(f"SELECT id, (CASE WHEN id % 2 = 0 THEN 5 ELSE 10 END)::INTEGER AS points, (CASE WHEN id % 2 = 0 THEN 144 ELSE 128 END)::DOUBLE AS area FROM ({_SHAPES})")
def shape_simplify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points on straight edges go, of shells and of holes."""
    k = F.col("p_partkey")
    x, y = F.lit(595000.0) + 40 * (k % 50), F.lit(6401000.0) + 40 * F.floor(k / 50)
    shell = _ring(x, y, (0, 0), (0, 5), (0, 12), (6, 12), (12, 12), (12, 3), (12, 2), (12, 0), (7, 0))
    hole = _ring(x + 4, y + 4, (0, 0), (2, 0), (4, 0), (4, 4), (1, 4), (0, 4))
    g = F.array(F.when(k % 2 == 0, F.array(shell)).otherwise(F.array(shell, hole)))
    df = _parts(spark, sf_dir).select(k.alias("id"), g.alias("g")).select("id", repair.simplified(F.col("g")).alias("thin"))
    return df.select("id", G.n_points(F.col("thin")).alias("points"), F.round(G.area(F.col("thin")), 6).alias("area"))


@query(f"SELECT id, kind NOT IN (4, 5) AS written, CASE WHEN kind NOT IN (4, 5) THEN TRUE END AS same, CASE WHEN kind NOT IN (4, 5) THEN TRUE END AS same_text FROM ({_SHAPES})")
def codec_round_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-known binary and text, written and read again; null and empty geometries have no binary."""
    df = shapes(spark, sf_dir).withColumn("b", wkb.to_wkb(F.col("geometry"))).withColumn("back", wkb.from_wkb(F.col("b")))
    text = G.from_wkt(F.when(F.size("geometry") > 0, G.wkt(F.col("geometry"))))
    return df.select("id", F.col("b").isNotNull().alias("written"), (F.col("back") == F.col("geometry")).alias("same"), (text == F.col("geometry")).alias("same_text"))


@query(f"""
    SELECT id, (100 - CASE WHEN side = 10 THEN 100 ELSE greatest(0, 10 - d) * 10 END)::DOUBLE AS rest, (100 - CASE WHEN side = 10 THEN 0 ELSE greatest(0, 10 - d) * 10 END)::DOUBLE AS other
    FROM (SELECT *, id % 13 AS d FROM ({_SHAPES}))""")
def overlay_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A square without one that is shifted by 0 to 12 m, the other way round, and with itself where the side is 10."""
    k = F.col("p_partkey")
    x, y = F.lit(595000.0) + 40 * (k % 50), F.lit(6401000.0) + 40 * F.floor(k / 50)
    df = _parts(spark, sf_dir).select(k.alias("id"), F.array(F.array(_square(x, y, 10))).alias("a"), F.array(F.array(_square(x + k % 13, y, 10))).alias("b"))
    same = F.col("id") % 3 == 0
    out = df.select("id", repair.difference(F.col("a"), F.when(same, F.col("a")).otherwise(F.col("b"))).alias("r"), repair.difference(F.col("b"), F.when(same, F.lit(None)).otherwise(F.col("a"))).alias("o"))
    return out.select("id", F.round(G.area(F.col("r")), 6).alias("rest"), F.round(G.area(F.col("o")), 6).alias("other"))


@query(f"SELECT id, part::INTEGER AS part, (CASE WHEN kind = 3 AND part = 1 THEN 16 WHEN kind = 3 THEN 100 ELSE {_AREA} END)::DOUBLE AS area FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS part FROM ({_SHAPES}) WHERE kind IN (0, 2, 3))")
def multipolygon_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = shapes(spark, sf_dir).where("kind IN (0, 2, 3)").select("id", F.posexplode(G.parts(F.col("geometry"))).alias("part", "g"))
    return df.select("id", "part", F.round(G.area(F.col("g")), 6).alias("area"))


_CHAINS = "SELECT p_partkey AS id, p_partkey // 10 AS chain, p_partkey % 10 AS i FROM part"


def _overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten squares of 15 m in a row, each 10 m after the one before, so they overlap; each is there twice. Rows are 40 m
    apart. Status: the first five need action, all but the first three claim to be completed, the last is not known."""
    k = F.col("p_partkey")
    x, y = F.lit(595000.0) + 10 * (k % 10), F.lit(6401000.0) + 40 * F.floor(k / 10)
    df = _parts(spark, sf_dir).select(k.alias("id"), F.array(F.array(_square(x, y, 15))).alias("geometry"))
    return df.unionAll(df)


@query(f"SELECT (15 * 15 + (n - 1) * 150)::DOUBLE AS area, count(*) AS parts FROM (SELECT chain, count(*) AS n FROM ({_CHAINS}) GROUP BY 1) GROUP BY 1")
def layer_dissolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping and repeated features as one polygon a row of them, over tiles that cut them."""
    parts = repair.dissolved_parts(_overlapping(spark, sf_dir).withColumn("layer", F.lit(1)), 64.0, ["layer"])
    return parts.select(F.round(G.area(F.col("geometry")), 3).alias("area")).groupBy("area").agg(F.count("*").alias("parts"))


@query(f"""
    WITH c AS (SELECT chain, i FROM ({_CHAINS})), a AS (SELECT chain, (15 * (15 + 10 * (max(i) - min(i))))::DOUBLE AS action, max(i) AS last FROM c WHERE i < 5 GROUP BY 1),
    b AS (SELECT c.chain, (max(i) * 10 + 15 - greatest(30, coalesce(any_value(last) * 10 + 15, 30))) * 15.0 AS completed FROM c LEFT JOIN a USING (chain) WHERE i BETWEEN 3 AND 8 GROUP BY 1)
    SELECT 'Action Required' AS status_category, count(*) AS parts, round(sum(action), 3) AS area FROM a UNION ALL
    SELECT 'Completed', count(*), round(sum(completed)::DOUBLE, 3) FROM b WHERE completed > 0""")
def status_dissolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The union of what needs action, and the union of what is completed without it, as parts; what is not known is left out."""
    df = _overlapping(spark, sf_dir).withColumn("i", F.col("id") % 10)
    action, done = df.where("i < 5"), df.where("i BETWEEN 3 AND 8")
    layers = action.withColumn("status_category", F.lit("Action Required")).unionByName(done.withColumn("status_category", F.lit("Completed"))).unionByName(df.where("i = 9").withColumn("status_category", F.lit("Unknown")))
    parts = formats.dissolve_by_status(layers.select("status_category", "geometry"), 64.0)
    return parts.groupBy("status_category").agg(F.count("*").alias("parts"), F.round(F.sum(G.area(F.col("geometry"))), 3).alias("area"))


@query(f"SELECT (CASE WHEN id % 4 = 0 THEN 12 WHEN id % 4 = 1 THEN 60 ELSE 0 END)::INTEGER AS gridcode, count(*) AS features, round(sum({_AREA}), 3) AS area FROM ({_SHAPES}) WHERE kind NOT IN (4, 5) GROUP BY 1")
def formatted_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The format step: codes as numbers, null and empty shapes out, the others repaired."""
    code = F.when(F.col("id") % 4 == 0, "12").when(F.col("id") % 4 == 1, " 60 ").when(F.col("id") % 4 == 2, "none")
    out = formats.format_cells(shapes(spark, sf_dir).withColumn("gridcode", code))
    return out.groupBy("gridcode").agg(F.count("*").alias("features"), F.round(F.sum(G.area(F.col("geometry"))), 3).alias("area"))


@query(f"SELECT count(*) AS features, count(*) FILTER (kind NOT IN (4, 5)) AS with_geometry, count(*) FILTER (kind NOT IN (4, 5) AND id % 3 <> 1) AS readable FROM ({_SHAPES})")
def input_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features, those with binary, and those whose binary can be read; every third is cut short."""
    b = wkb.to_wkb(F.col("geometry"))
    df = shapes(spark, sf_dir).withColumn("b", b).withColumn("b", F.when(F.col("id") % 3 == 1, F.substring("b", 1, 20)).otherwise(F.col("b")))
    return formats.input_stats(df, "b")


@query(f"""
    SELECT count(*) AS features, round(avg(n), 6) AS avg_points, min(n)::INTEGER AS min_points, max(n)::INTEGER AS max_points, round(avg(a), 1) AS avg_area, round(min(a), 1) AS min_area, round(max(a), 1) AS max_area
    FROM (SELECT CASE kind WHEN 0 THEN 5 ELSE 10 END AS n, {_AREA} AS a FROM ({_SHAPES}) WHERE kind IN (0, 2, 3)) WHERE a >= 90""")
def validated_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary in degrees through the filtering step, and what is left of it."""
    g = crs.transformed(F.col("geometry"), crs.to_wgs84)
    df = shapes(spark, sf_dir, on_ground=True).where("kind <> 6").select("id", wkb.to_wkb(g).alias("geometry"))
    return formats.validated_stats(repair.filtering_pipeline(df, min_area=90.0))


@query(f"SELECT id, round({_AREA}, 1) AS area, 4326::INTEGER AS srid, TRUE AS inside FROM ({_SHAPES}) WHERE kind NOT IN (4, 5)")
def geometry_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole batches through the gate: repaired, in degrees, null and empty ones dropped."""
    out = repair.standard_pipeline(shapes(spark, sf_dir, on_ground=True))
    back = G.area(crs.transformed(F.col("geometry"), crs.to_utm32))
    return out.select("id", F.round(back, 1).alias("area"), "srid", F.forall(G.points(F.col("geometry")), lambda p: p["x"].between(8, 13) & p["y"].between(54, 58)).alias("inside"))


@query(f"""
    WITH s AS (SELECT *, x + d AS bx FROM (SELECT *, id % 7 AS d FROM ({_SHAPES})))
    SELECT id, (id + 0) AS neighbour, ((10 - d) * 10)::DOUBLE AS common FROM s WHERE d < 10""")
def tile_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares to the squares of another layer that they share ground with: by tiles, then exactly, each pair once."""
    k = F.col("p_partkey")
    x, y = F.lit(595000.0) + 40 * (k % 50), F.lit(6401000.0) + 40 * F.floor(k / 50)
    layer = lambda shift, name: _parts(spark, sf_dir).select(k.alias(name), F.array(F.array(_square(x + shift, y, 10))).alias("geometry"))
    return spatial.overlap_join(layer(F.lit(0), "id"), layer(k % 7, "neighbour"), "id", "neighbour", 25.0).select("id", "neighbour", F.round("common", 6).alias("common"))


@query("""
    SELECT a.p_partkey AS src, b.p_partkey AS dst, (10 + 2.5 * (a.p_partkey % 3))::DOUBLE AS length FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1
    WHERE a.p_partkey % 2 = 0 AND 10 + 2.5 * (a.p_partkey % 3) >= 12""")
def shared_borders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours that share 12 m of border or more; their corners do not meet and lie on no grid."""
    k = F.col("p_partkey")
    pair = F.floor(k / 2)
    x, y, h = F.lit(595000.25) + 60 * (pair % 50), F.lit(6401000.25) + 60 * F.floor(pair / 50), F.lit(10) + 2.5 * ((2 * pair) % 3)
    left = F.array(F.array(_ring(x, y, (0, 0), (0, 30), (20, 30), (20, 0))))
    right = F.array(F.array(F.array(*(G.point(x + a, y + b) for a, b in ((20, F.lit(4)), (20, h + 4), (30, h + 4), (30, F.lit(4)), (20, F.lit(4)))))))
    df = _parts(spark, sf_dir).select(k.alias("id"), F.when(k % 2 == 0, left).otherwise(right).alias("geometry"))
    return spatial.border_links(df, "id", 12.0, 50.0).select("src", "dst", F.round("length", 6).alias("length"))
