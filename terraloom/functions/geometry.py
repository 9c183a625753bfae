"""Geometry as ordinary Spark types, and its measures as column expressions.

point: struct<x, y>; ring: array<point>, closed; polygon: array<ring>, the shell first; geometry: array<polygon>.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RING = "array<struct<x:double,y:double>>"
GEOMETRY = f"array<array<{RING}>>"


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def closed(ring: Column) -> Column:
    """The ring with its first point at the end too."""
    return F.when(F.get(ring, F.lit(0)) == F.element_at(ring, -1), ring).otherwise(F.concat(ring, F.slice(ring, 1, 1)))


def ring_of_positions(text: Column, dimensions: int = 2, least: int = 4) -> Column:
    """A closed ring of a list of coordinates, of which the first two of each point are kept; null if it is too short.

    Coordinates that can't be read make the ring null.
    """

    def ring(n: Column) -> Column:
        whole = F.transform(F.sequence(F.lit(0), F.floor(F.size(n) / dimensions).cast("int") - 1), lambda i: F.struct(F.get(n, i * dimensions).alias("x"), F.get(n, i * dimensions + 1).alias("y")))
        return F.when((F.size(n) >= dimensions * least) & ~F.exists(n, lambda v: v.isNull()), let(whole, closed))

    return let(F.transform(F.split(F.trim(text), r"\s+"), lambda v: v.try_cast("double")), ring)


def polygon_geometry(rings: Column) -> Column:
    """One polygon: the first ring is the shell, the others are holes."""
    return F.when(F.size(rings) > 0, F.array(rings))


def multi_geometry(polygons: Column) -> Column:
    """Several polygons; those without a shell are left out."""
    return F.filter(polygons, lambda p: F.size(p) > 0)


def _edges(ring: Column, body) -> Column:
    """`body` of each edge of a closed ring: (from, to)."""
    return F.zip_with(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), body)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def signed_area(ring: Column) -> Column:
    """Positive for a ring that runs counter-clockwise. Coordinates count from the ring's first point, for precision."""

    def area(r: Column) -> Column:
        return let(F.get(r, F.lit(0)), lambda o: total(_edges(r, lambda p, q: (p["x"] - o["x"]) * (q["y"] - o["y"]) - (q["x"] - o["x"]) * (p["y"] - o["y"]))) / 2)

    return let(ring, area)


def is_ccw(ring: Column) -> Column:
    return signed_area(ring) > 0


def area(geometry: Column) -> Column:
    """Shells less holes, in square units."""
    ring_areas = lambda p: F.transform(p, lambda r, i: F.when(i == 0, F.abs(signed_area(r))).otherwise(-F.abs(signed_area(r))))
    return total(F.transform(geometry, lambda p: total(ring_areas(p))))


def hectares(geometry: Column) -> Column:
    return area(geometry) / 10000


def points(geometry: Column) -> Column:
    return F.flatten(F.flatten(geometry))


def n_points(geometry: Column) -> Column:
    return F.size(points(geometry))


def bbox(geometry: Column) -> Column:
    """struct<minx, miny, maxx, maxy>."""

    def box(p: Column) -> Column:
        xs, ys = F.transform(p, lambda q: q["x"]), F.transform(p, lambda q: q["y"])
        return F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"), F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))

    return let(points(geometry), box)


def centroid(geometry: Column) -> Column:
    """struct<x, y>, weighted by area; holes count against it. Null for a geometry without area."""

    def moments(r: Column, sign: Column) -> Column:
        o = F.get(r, F.lit(0))

        def of(o: Column) -> Column:
            cross = lambda p, q: (p["x"] - o["x"]) * (q["y"] - o["y"]) - (q["x"] - o["x"]) * (p["y"] - o["y"])
            a = total(_edges(r, cross)) / 2
            mx = total(_edges(r, lambda p, q: (p["x"] + q["x"] - 2 * o["x"]) * cross(p, q))) / 6
            my = total(_edges(r, lambda p, q: (p["y"] + q["y"] - 2 * o["y"]) * cross(p, q))) / 6
            turned = sign * F.when(a < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
            return F.struct((turned * a).alias("a"), (turned * (mx + o["x"] * a)).alias("mx"), (turned * (my + o["y"] * a)).alias("my"))

        return let(o, of)

    each = F.flatten(F.transform(geometry, lambda p: F.transform(p, lambda r, i: moments(r, F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0))))))

    def weighted(m: Column) -> Column:
        a = total(F.transform(m, lambda v: v["a"]))
        return F.when(a != 0, F.struct((total(F.transform(m, lambda v: v["mx"])) / a).alias("x"), (total(F.transform(m, lambda v: v["my"])) / a).alias("y")))

    return let(each, weighted)


def grid_aligned(geometry: Column, grid: float = 10.0, tolerance: float = 0.01) -> Column:
    """Every coordinate is within `tolerance` of a multiple of `grid`."""
    near = lambda v: F.abs(F.round(v / grid) * grid - v) < tolerance
    return F.forall(points(geometry), lambda p: near(p["x"]) & near(p["y"]))


def drop_repeated_points(geometry: Column) -> Column:
    return F.transform(geometry, lambda p: F.transform(p, lambda r: F.filter(r, lambda q, i: (i == 0) | (q != F.get(r, i - 1)))))


def ring_problems(geometry: Column) -> Column:
    """True if a ring, shell or hole, has fewer than four points or a point twice in a row."""
    bad = lambda r: (F.size(r) < 4) | F.exists(_edges(r, lambda p, q: p == q), lambda e: e)
    return F.exists(geometry, lambda p: F.exists(p, bad))


def edges_of(geometry: Column) -> Column:
    """array<struct<x1, y1, x2, y2>>: all directed edges, of shells and holes."""
    each = lambda r: _edges(r, lambda p, q: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2")))
    return F.flatten(F.transform(F.flatten(geometry), each))


def rings_by_turn(rings: Column) -> Column:
    """Polygons of rings whose turn tells shells (clockwise) from holes (counter-clockwise). A hole goes to the smallest
    shell that contains the middle of its first edge; a hole without a shell becomes a shell."""
    shells = F.filter(rings, lambda r: ~is_ccw(r))
    holes = F.filter(rings, lambda r: is_ccw(r))

    def inside(h: Column, s: Column) -> Column:
        a, b = F.get(h, F.lit(0)), F.get(h, F.lit(1))
        return contains(s, F.struct(((a["x"] + b["x"]) / 2).alias("x"), ((a["y"] + b["y"]) / 2).alias("y")))

    def built(s: Column) -> Column:
        owner = lambda h: F.array_min(F.filter(F.transform(s, lambda r, i: F.when(inside(h, r), F.struct(F.abs(signed_area(r)).alias("a"), i.alias("i")))), lambda x: x.isNotNull()))["i"]
        with_holes = F.transform(s, lambda r, i: F.concat(F.array(r), F.filter(holes, lambda h: owner(h) == i)))
        lone = F.transform(F.filter(holes, lambda h: owner(h).isNull()), lambda h: F.array(h))
        return F.concat(with_holes, lone)

    return let(shells, built)


def contains(ring: Column, p: Column) -> Column:
    """Whether a point is inside a ring, by the edges that a line to its right crosses."""
    crosses = lambda a, b: ((a["y"] > p["y"]) != (b["y"] > p["y"])) & (p["x"] < (b["x"] - a["x"]) * (p["y"] - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"])
    return F.size(F.filter(_edges(ring, crosses), lambda c: c)) % 2 == 1


def parts(geometry: Column) -> Column:
    """A multipolygon's polygons, each a geometry of its own."""
    return F.transform(geometry, lambda p: F.array(p))


def from_wkt(text: Column) -> Column:
    """Polygons of well-known text of a polygon or multipolygon; null for anything else and for unreadable numbers."""
    kind = F.upper(F.regexp_extract(text, r"^\s*([A-Za-z]+)", 1))
    body = F.regexp_replace(F.regexp_replace(text, r"^[^(]*\(+\s*", ""), r"\s*\)+\s*$", "")
    one = lambda r: F.transform(F.split(F.trim(r), r"\s*,\s*"), lambda p: F.struct(F.get(F.split(p, r"\s+"), F.lit(0)).try_cast("double").alias("x"), F.get(F.split(p, r"\s+"), F.lit(1)).try_cast("double").alias("y")))
    built = F.transform(F.split(body, r"\)\s*\)\s*,\s*\(\s*\("), lambda p: F.transform(F.split(p, r"\)\s*,\s*\("), one))
    good = lambda g: F.forall(points(g), lambda q: q["x"].isNotNull() & q["y"].isNotNull())
    return F.when(kind.isin("POLYGON", "MULTIPOLYGON"), let(built, lambda g: F.when(good(g), g)))


def wkt(geometry: Column) -> Column:
    """Well-known text of a multipolygon."""
    ring = lambda r: F.concat(F.lit("("), F.array_join(F.transform(r, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", "), F.lit(")"))
    polygon = lambda p: F.concat(F.lit("("), F.array_join(F.transform(p, ring), ", "), F.lit(")"))
    return F.concat(F.lit("MULTIPOLYGON ("), F.array_join(F.transform(geometry, polygon), ", "), F.lit(")"))
