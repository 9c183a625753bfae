"""UTM zone 32 on the GRS80 ellipsoid <-> longitude and latitude, by the published Krueger series to n^4."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from terraloom.functions.geometry import let

#: Ellipsoid, scale, central meridian, false easting.
SEMI_MAJOR, FLATTENING, SCALE, MERIDIAN, EASTING = 6378137.0, 1 / 298.257222101, 0.9996, 9.0, 500000.0
_N = FLATTENING / (2 - FLATTENING)
RADIUS = SCALE * SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)


def _series(value: Column, terms) -> Column:
    for t in terms:
        value = value + t
    return value


def to_wgs84(x: Column, y: Column) -> Column:
    """struct<x, y>: longitude and latitude in degrees of easting and northing. What a step needs more than once is computed
    once: in functions of arrays Spark would compute it as often as it is named."""

    def moved(p: Column) -> Column:
        xi, eta = p["xi"], p["eta"]
        xi1 = _series(xi, (-b * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, b in enumerate(BETA, 1)))
        eta1 = _series(eta, (-b * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, b in enumerate(BETA, 1)))
        return let(F.struct(xi1.alias("xi1"), eta1.alias("eta1")), angles)

    def angles(p: Column) -> Column:
        lon = F.degrees(F.atan2(F.sinh(p["eta1"]), F.cos(p["xi1"]))) + MERIDIAN
        lat = lambda chi: F.degrees(_series(chi, (d * F.sin(2 * j * chi) for j, d in enumerate(DELTA, 1))))
        return F.struct(lon.alias("x"), let(F.asin(F.sin(p["xi1"]) / F.cosh(p["eta1"])), lat).alias("y"))

    return let(F.struct((y / RADIUS).alias("xi"), ((x - EASTING) / RADIUS).alias("eta")), moved)


def to_utm32(lon: Column, lat: Column) -> Column:
    """struct<x, y>: easting and northing of degrees."""
    c = 2 * math.sqrt(_N) / (1 + _N)

    def turned(p: Column) -> Column:
        t = F.sinh(F.atanh(p["s"]) - c * F.atanh(c * p["s"]))
        return let(F.struct(t.alias("t"), p["lam"].alias("lam")), flat)

    def flat(p: Column) -> Column:
        t, lam = p["t"], p["lam"]
        return let(F.struct(F.atan2(t, F.cos(lam)).alias("xi"), F.atanh(F.sin(lam) / F.sqrt(1 + t * t)).alias("eta")), moved)

    def moved(p: Column) -> Column:
        xi, eta = p["xi"], p["eta"]
        x = _series(eta, (a * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, a in enumerate(ALPHA, 1)))
        y = _series(xi, (a * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, a in enumerate(ALPHA, 1)))
        return F.struct((x * RADIUS + EASTING).alias("x"), (y * RADIUS).alias("y"))

    return let(F.struct(F.sin(F.radians(lat)).alias("s"), F.radians(lon - MERIDIAN).alias("lam")), turned)


def transformed(geometry: Column, to) -> Column:
    """A geometry with each point taken through `to`."""
    return F.transform(geometry, lambda p: F.transform(p, lambda r: F.transform(r, lambda q: to(q["x"], q["y"]))))


#: Where the register's coordinates must lie, before and after.
UTM_BOUNDS, WGS_BOUNDS = (400000, 900000, 6000000, 6500000), (8, 13, 54, 58)


#: The same for the whole zone: eastings and northings of the northern half, and its degrees with some of its neighbours.
ZONE = ((100000, 900000, 0, 9400000), (0, 18, 0, 84))


def checked_point(x: Column, y: Column, utm: tuple = UTM_BOUNDS, wgs: tuple = WGS_BOUNDS) -> Column:
    """struct<x, y> in degrees of a register's coordinates; null if they lie outside the bounds before or after."""
    before = x.between(*utm[:2]) & y.between(*utm[2:])
    return F.when(before, let(to_wgs84(x, y), lambda p: F.when(p["x"].between(*wgs[:2]) & p["y"].between(*wgs[2:]), p)))
