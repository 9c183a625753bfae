"""Tiles, adjacency, components and dissolve of polygon layers, as equi-joins and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraloom.functions import geometry as G
from terraloom.operators.components import connected_components
from terraloom.session import checkpointed, settled, spread


def tiles_of(box: Column, size: float) -> Column:
    """array<struct<tx, ty>>: every tile of a square grid that a box touches."""
    steps = lambda low, high: F.sequence(F.floor(low / size), F.floor(high / size))
    return F.flatten(F.transform(steps(box["minx"], box["maxx"]), lambda x: F.transform(steps(box["miny"], box["maxy"]), lambda y: F.struct(x.alias("tx"), y.alias("ty")))))


def assign_tiles(df: DataFrame, size: float, geometry: str = "geometry") -> DataFrame:
    return df.withColumn("tile", F.explode(tiles_of(G.bbox(F.col(geometry)), size)))


def tile_size(df: DataFrame, geometry: str = "geometry") -> float:
    """The side of about n tiles over the layer's bounds, for n features: ceil(sqrt(n)) tiles along the longer side."""
    b = df.select(G.bbox(F.col(geometry)).alias("b")).agg(F.count("*").alias("n"), *(f(F.col(f"b.{k}")).alias(k) for k, f in (("minx", F.min), ("miny", F.min), ("maxx", F.max), ("maxy", F.max)))).head()
    if not b.n:
        return 1.0
    side = max(b.maxx - b.minx, b.maxy - b.miny)
    return max(side / (int(b.n**0.5) + 1), 1e-9)


def vertex_links(df: DataFrame, id_col: str, group: str, geometry: str = "geometry") -> DataFrame:
    """(src, dst) that join features of a group that share a vertex (queen contiguity). Each vertex links its features to
    its smallest one, so a vertex with many features gives as many links, not all pairs, and none is lost for components."""
    at = df.select(id_col, group, F.explode(F.array_distinct(G.points(F.col(geometry)))).alias("p"))
    least = at.groupBy(group, "p").agg(F.min(id_col).alias("dst"), F.count("*").alias("n")).where("n > 1").drop("n")
    return at.join(least, [group, "p"]).where(F.col(id_col) != F.col("dst")).select(F.col(id_col).alias("src"), "dst").distinct()


def unit_edges(df: DataFrame, keep: list[str], grid: float = 10.0, geometry: str = "geometry") -> DataFrame:
    """Edges of grid-aligned features cut at the grid's lines, with their ends in order, so that features of different
    size meet in equal pieces: `keep`, x1, y1, x2, y2 in grid steps, and `way`: 1 where the feature is to the right of the
    way from (x1, y1) to (x2, y2), else -1."""
    rings = df.select(*keep, F.explode(geometry).alias("p")).select(*keep, F.posexplode("p").alias("i", "r"))
    e = rings.select(*keep, F.when(G.is_ccw(F.col("r")) == (F.col("i") > 0), 1).otherwise(-1).alias("way"), F.explode(G.edges_of(F.array(F.array("r")))).alias("e"))
    at = lambda c: F.round(F.col(f"e.{c}") / grid).cast("long")
    e = e.select(*keep, "way", at("x1").alias("ax"), at("y1").alias("ay"), at("x2").alias("bx"), at("y2").alias("by"))
    n = F.greatest(F.abs(F.col("bx") - F.col("ax")), F.abs(F.col("by") - F.col("ay")))
    e = e.where(n > 0).withColumn("n", n).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    step = lambda a, b, k: F.col(a) + F.expr(f"({b} - {a}) div n") * k
    first = F.struct(step("ax", "bx", F.col("k")).alias("x"), step("ay", "by", F.col("k")).alias("y"))
    last = F.struct(step("ax", "bx", F.col("k") + 1).alias("x"), step("ay", "by", F.col("k") + 1).alias("y"))
    e = e.select(*keep, F.when(first < last, F.col("way")).otherwise(-F.col("way")).alias("way"), F.least(first, last).alias("a"), F.greatest(first, last).alias("b"))
    return e.select(*keep, "way", F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2"))


def edge_links(df: DataFrame, id_col: str, group: str, grid: float = 10.0, geometry: str = "geometry") -> DataFrame:
    """(src, dst) that join features of a group that share at least one grid step of an edge."""
    at = unit_edges(df, [id_col, group], grid, geometry)
    key = [group, "x1", "y1", "x2", "y2"]
    least = at.groupBy(*key).agg(F.min(id_col).alias("dst"), F.count("*").alias("n")).where("n > 1").drop("n")
    return at.join(least, key).where(F.col(id_col) != F.col("dst")).select(F.col(id_col).alias("src"), "dst").distinct()


def components(df: DataFrame, links: DataFrame, id_col: str) -> DataFrame:
    """`df` with component_id, the smallest id of the feature's component; a feature without links is its own."""
    found = connected_components(links).select(F.col("node").alias(id_col), "component")
    return df.join(found, id_col, "left").withColumn("component_id", F.coalesce("component", id_col)).drop("component")


def boundary(df: DataFrame, by: list[str], grid: float = 10.0, geometry: str = "geometry") -> DataFrame:
    """The unit edges that remain when features of a group are dissolved: those seen an odd number of times, with the
    side (`way`) on which the features are. Repeated features count once; features that overlap without being equal are for `repair.dissolved_parts`."""
    key = [*by, "x1", "y1", "x2", "y2"]
    once = df.select(*by, F.col(geometry).alias("geometry")).dropDuplicates()
    return unit_edges(once, by, grid).groupBy(*key).agg(F.count("*").alias("n"), F.sum("way").alias("way")).where("n % 2 = 1").drop("n")


def _followed(edges: DataFrame, by: list[str]) -> DataFrame:
    """(id, next, turns) of boundary edges that run with the inside on their right: what follows each, and whether it leads on in
    another direction. Where four edges meet, the sharpest turn to the right is taken, so parts that touch in a point stay
    apart."""
    out = edges.select(*by, F.col("fx").alias("tx"), F.col("fy").alias("ty"), F.col("id").alias("next"), (F.col("tx") - F.col("fx")).alias("nx"), (F.col("ty") - F.col("fy")).alias("ny"))
    both = edges.join(out, [*by, "tx", "ty"]).withColumns({"dx": F.col("tx") - F.col("fx"), "dy": F.col("ty") - F.col("fy")})
    cross, dot = F.expr("dx * ny - dy * nx"), F.expr("dx * nx + dy * ny")
    least = F.min_by(F.struct("next", (cross != 0).alias("turns")), F.atan2(cross.cast("double"), dot.cast("double")))
    return both.where(~((cross == 0) & (dot < 0))).groupBy("id").agg(least.alias("n")).select("id", "n.next", "n.turns")


def _ranked_rings(followed: DataFrame) -> DataFrame:
    """(id, ring, steps): of each edge the smallest edge of its ring and how many steps lead on to it. Pointers are doubled: a round
    joins the edges with what they point at, so a ring of n edges takes log2(n) rounds, and no task walks a ring."""
    state = settled(followed.select("id", "next", F.col("id").alias("ring"), F.lit(0).cast("long").alias("steps")))
    hop = 1
    while True:
        ahead = state.select(F.col("id").alias("next"), F.col("next").alias("after"), F.col("ring").alias("r"), F.col("steps").alias("s"))
        less = F.col("r") < F.col("ring")
        state = settled(
            state.join(ahead, "next").select(
                "id", F.col("after").alias("next"), F.least("r", "ring").alias("ring"), F.when(less, F.col("s") + hop).otherwise(F.col("steps")).alias("steps"), less.alias("changed")
            )
        )
        if state.where("changed").isEmpty():
            return state.select("id", "ring", "steps")
        hop *= 2


def _owners(edges: DataFrame, rings: DataFrame, by: list[str]) -> DataFrame:
    """(ring, shell): the shell that each ring belongs to. In the row of a hole's leftmost edge the next edge to the left is one of
    its shell, or of a hole further left in the same shell; these pointers are jumped to their ends."""
    row, at = F.least("fy", "ty"), F.col("fx") + F.col("tx")
    left = F.lag("ring").over(Window.partitionBy(*by, "row").orderBy("at"))
    seen = edges.where("fy <> ty").withColumns({"row": row, "at": at}).withColumn("left", left)
    first = seen.groupBy("ring").agg(F.min_by("left", F.struct("at", "row")).alias("left"))
    up = settled(rings.join(first, "ring").select("ring", F.when(F.col("hole"), F.col("left")).otherwise(F.col("ring")).alias("shell")))
    while True:
        above = up.select(F.col("ring").alias("shell"), F.col("shell").alias("above"))
        jumped = settled(up.join(above, "shell").select("ring", F.col("above").alias("shell"), (F.col("above") != F.col("shell")).alias("moved")))
        up = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            return up


def stitch(edges: DataFrame, by: list[str], grid: float = 10.0) -> DataFrame:
    """Dissolved geometries of `boundary`'s edges: rings in order, collinear points dropped, each hole with its shell.

    Edges are ranked in their rings by pointer doubling and holes find their shells by the edges of a grid row, all in joins
    and windows over rows of the grid, so a component of any size is spread over all tasks; only its finished rings come
    together, as they are one value of the result. No edges: no rows."""
    ends = lambda a, b: F.when(F.col("way") > 0, F.col(a)).otherwise(F.col(b)).cast("long")
    given = edges.select(*by, ends("x1", "x2").alias("fx"), ends("y1", "y2").alias("fy"), ends("x2", "x1").alias("tx"), ends("y2", "y1").alias("ty"))
    numbered = settled(given.withColumn("id", F.monotonically_increasing_id()))
    followed = settled(_followed(numbered, by))
    placed = settled(numbered.join(followed.select("id", "turns"), "id").join(_ranked_rings(followed), "id"))
    # From the ring's first edge on, which has no step to go; twice the area is negative where the inside is that of a shell.
    corner = F.struct(F.when(F.col("steps") == 0, F.lit(None)).otherwise(-F.col("steps")).alias("k"), (F.col("tx") * F.lit(float(grid))).alias("x"), (F.col("ty") * F.lit(float(grid))).alias("y"))
    points = F.transform(F.sort_array(F.collect_list(F.when(F.col("turns"), corner))), lambda p: F.struct(p["x"], p["y"]))
    rings = placed.groupBy(*by, "ring").agg(F.sum(F.expr("fx * ty - tx * fy")).alias("twice"), points.alias("p"))
    rings = settled(rings.select(*by, "ring", (F.col("twice") > 0).alias("hole"), F.concat("p", F.slice("p", 1, 1)).alias("p")))
    owned = rings.join(_owners(placed, rings.select("ring", "hole"), by), "ring")
    each = owned.groupBy(*by, "shell").agg(F.sort_array(F.collect_list(F.struct("hole", "ring", "p"))).alias("r")).withColumn("r", F.transform("r", lambda x: x["p"]))
    return each.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("shell", "r"))).alias("g")).select(*by, F.transform("g", lambda x: x["r"]).cast(G.GEOMETRY).alias("geometry"))


def merge_efficiency(merged: DataFrame, by: str, count: str = "merged_count") -> DataFrame:
    """Original and merged features, reduction in percent and compression, by code and over all (null code)."""
    sums = merged.rollup(by).agg(F.sum(count).cast("long").alias("original"), F.count("*").alias("merged"))
    return sums.withColumns(
        {
            "reduction_pct": F.when(F.col("original") > 0, F.round(100 * (1 - F.col("merged") / F.col("original")), 1)).otherwise(F.lit(0.0)),
            "compression": F.when(F.col("merged") > 0, F.round(F.col("original") / F.col("merged"), 1)).otherwise(F.lit(1.0)),
        }
    )


def overlap_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, size: float) -> DataFrame:
    """(left id, right id, common): pairs of features that share ground, with its area; each pair once.

    Both sides go to the tiles that their boxes touch; a pair is kept in the tile that holds the lower left corner of the
    boxes' intersection alone, so nothing is made distinct afterwards. Then the exact overlay decides.
    """
    from terraloom.operators import repair

    a = assign_tiles(left.select(left_id, F.col("geometry").alias("a")), size, "a").withColumn("abox", G.bbox(F.col("a")))
    b = assign_tiles(right.select(right_id, F.col("geometry").alias("b")), size, "b").withColumn("bbox", G.bbox(F.col("b")))
    x, y = F.greatest("abox.minx", "bbox.minx"), F.greatest("abox.miny", "bbox.miny")
    meet = (x <= F.least("abox.maxx", "bbox.maxx")) & (y <= F.least("abox.maxy", "bbox.maxy"))
    here = (F.floor(x / size) == F.col("tile.tx")) & (F.floor(y / size) == F.col("tile.ty"))
    pairs = spread(a.join(b, "tile").where(meet & here).select(left_id, right_id, "a", "b"), left_id, right_id).select(left_id, right_id, repair.intersection(F.col("a"), F.col("b")).alias("both"))
    return pairs.select(left_id, right_id, G.area(F.col("both")).alias("common")).where("common > 0")


def border_links(df: DataFrame, id_col: str, least: float, size: float, geometry: str = "geometry") -> DataFrame:
    """(src, dst, length): features that share `least` or more of border, on edges that lie on one line and run against each
    other, wherever their corners are. Edges meet by their line (its direction and distance, in parts of 1e-6 and 1e-3) and
    by the stretches of `size` along it that they touch; a pair's overlap is counted in the stretch where it begins."""
    e = df.select(id_col, F.explode(G.edges_of(F.col(geometry))).alias("e")).select(id_col, "e.*").where("x1 <> x2 OR y1 <> y2")
    long = F.sqrt((F.col("x2") - F.col("x1")) * (F.col("x2") - F.col("x1")) + (F.col("y2") - F.col("y1")) * (F.col("y2") - F.col("y1")))
    ux, uy = (F.col("x2") - F.col("x1")) / long, (F.col("y2") - F.col("y1")) / long
    flip = F.when((F.round(ux, 6) < 0) | ((F.round(ux, 6) == 0) & (uy < 0)), -1.0).otherwise(1.0)
    e = e.withColumns({"ux": ux * flip, "uy": uy * flip, "way": flip})
    along = lambda i: F.col(f"x{i}") * F.col("ux") + F.col(f"y{i}") * F.col("uy")
    e = e.select(
        id_col, "way", F.round("ux", 6).alias("dx"), F.round("uy", 6).alias("dy"), F.round(F.col("y1") * F.col("ux") - F.col("x1") * F.col("uy"), 3).alias("off"),
        F.least(along(1), along(2)).alias("low"), F.greatest(along(1), along(2)).alias("high"),
    ).withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / size), F.floor(F.col("high") / size))))
    key = ["dx", "dy", "off", "cell"]
    a = e.where("way > 0").select(*key, F.col(id_col).alias("p"), F.col("low").alias("l1"), F.col("high").alias("h1"))
    b = e.where("way < 0").select(*key, F.col(id_col).alias("q"), F.col("low").alias("l2"), F.col("high").alias("h2"))
    start, stop = F.greatest("l1", "l2"), F.least("h1", "h2")
    pairs = a.join(b, key).where((F.col("p") != F.col("q")) & (stop > start) & (F.floor(start / size) == F.col("cell")))
    return pairs.groupBy(F.least("p", "q").alias("src"), F.greatest("p", "q").alias("dst")).agg(F.sum(stop - start).alias("length")).where(F.col("length") >= least - 1e-6)
