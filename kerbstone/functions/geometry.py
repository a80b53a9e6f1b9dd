"""Polyline kernels as Column expressions over array<struct<x double, y double>> in metres, unless noted."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

# GRS80 and zone 10 north of the universal transverse Mercator grid.
_A, _F, _K0, _E0, _LON0 = 6378137.0, 1 / 298.257222101, 0.9996, 500000.0, -123.0
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Krueger's series to the fourth order in the third flattening.
_ALPHA = [_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180, 13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440, 61 * _N**3 / 240 - 103 * _N**4 / 140, 49561 * _N**4 / 161280]
_BETA = [_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360, _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440, 17 * _N**3 / 480 - 37 * _N**4 / 840, 4397 * _N**4 / 161280]
_ECC = 2 * math.sqrt(_N) / (1 + _N)


def to_utm(lon: Column, lat: Column) -> Column:
    """struct(x, y) in metres of degrees."""
    s, lam = F.sin(F.radians(lat)), F.radians(lon - _LON0)
    t = F.sinh(F.atanh(s) - _ECC * F.atanh(_ECC * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return F.struct((_E0 + _K0 * _RADIUS * east).alias("x"), (_K0 * _RADIUS * north).alias("y"))


def to_degrees(x: Column, y: Column) -> Column:
    """struct(x, y) in degrees, longitude first, of metres."""
    xi, eta = y / (_K0 * _RADIUS), (x - _E0) / (_K0 * _RADIUS)
    xi0, eta0 = xi, eta
    for j, b in enumerate(_BETA, 1):
        xi0 = xi0 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta0 = eta0 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi0) / F.cosh(eta0))
    lat = chi
    # from the conformal to the geodetic latitude
    delta = [2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45, 7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45, 56 * _N**3 / 15 - 136 * _N**4 / 35, 4279 * _N**4 / 630]
    for j, d in enumerate(delta, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return F.struct((_LON0 + F.degrees(F.atan2(F.sinh(eta0), F.cos(xi0)))).alias("x"), F.degrees(lat).alias("y"))


def segments(line: Column) -> Column:
    """array<struct<ax, ay, bx, by>> of the line's consecutive points."""
    return F.transform(
        F.when(F.size(line) > 1, F.sequence(F.lit(0), F.size(line) - 2)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(line[i]["x"].alias("ax"), line[i]["y"].alias("ay"), line[i + 1]["x"].alias("bx"), line[i + 1]["y"].alias("by")),
    )


def bound(x: Column, made) -> Column:
    """``made`` of a name for ``x``, so that an expression is evaluated once however often it is used."""
    return F.transform(F.array(x), made)[0]


def length(line: Column) -> Column:
    return bound(line, lambda v: F.aggregate(segments(v), F.lit(0.0), lambda t, s: t + F.hypot(s["bx"] - s["ax"], s["by"] - s["ay"])))


def relative_error(measured: Column, reported: Column) -> Column:
    """Null where nothing, or a length of zero, is reported."""
    return F.abs(measured - reported) / F.nullif(reported, F.lit(0.0))


def _along(line: Column) -> Column:
    """Per segment: the distance to its start, and its length."""
    return bound(line, _walked)


def _walked(line: Column) -> Column:
    return F.aggregate(
        segments(line),
        F.struct(F.lit(0.0).alias("d"), F.array().cast("array<struct<d:double,w:double,ax:double,ay:double,bx:double,by:double>>").alias("out")),
        lambda t, s: F.struct(
            (t["d"] + F.hypot(s["bx"] - s["ax"], s["by"] - s["ay"])).alias("d"),
            F.concat(t["out"], F.array(F.struct(t["d"].alias("d"), F.hypot(s["bx"] - s["ax"], s["by"] - s["ay"]).alias("w"), s["ax"].alias("ax"), s["ay"].alias("ay"), s["bx"].alias("bx"), s["by"].alias("by")))).alias("out"),
        ),
        lambda t: t["out"],
    )


def interpolate(line: Column, distance: Column, normalised: bool = False) -> Column:
    """The point at a distance along the line (or a share of it), within its ends."""

    def at(along: Column) -> Column:
        total = F.element_at(along, -1)["d"] + F.element_at(along, -1)["w"]
        want = F.greatest(F.lit(0.0), F.least(total, distance * total if normalised else distance))
        return F.struct(want.alias("want"), F.element_at(F.filter(along, lambda s: s["d"] <= want), -1).alias("s"))

    def point(x: Column) -> Column:
        s = x["s"]
        share = F.coalesce(F.least(F.lit(1.0), (x["want"] - s["d"]) / F.nullif(s["w"], F.lit(0.0))), F.lit(0.0))
        return F.struct((s["ax"] + share * (s["bx"] - s["ax"])).alias("x"), (s["ay"] + share * (s["by"] - s["ay"])).alias("y"))

    # an array of one binds a name, so that the walk along the line is made once
    return F.transform(F.transform(F.array(_along(line)), at), point)[0]


def nearest_share(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Which share of the segment lies before the point nearest to (px, py)."""
    dx, dy = bx - ax, by - ay
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(((px - ax) * dx + (py - ay) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0))))


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    t = nearest_share(px, py, ax, ay, bx, by)
    return F.hypot(px - ax - t * (bx - ax), py - ay - t * (by - ay))


def project(line: Column, px: Column, py: Column) -> Column:
    """struct(gap, at): the least distance to the line, and how far along it; ties nearer to the start."""
    return F.array_min(F.transform(_along(line), lambda s: F.struct(
        segment_distance(px, py, s["ax"], s["ay"], s["bx"], s["by"]).alias("gap"),
        (s["d"] + s["w"] * nearest_share(px, py, s["ax"], s["ay"], s["bx"], s["by"])).alias("at"))))


def in_polygon(px: Column, py: Column, ring: list[tuple[float, float]]) -> Column:
    """Ray casting against a closed ring of literal corners."""
    inside = F.lit(False)
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        crosses = (F.lit(y1) > py) != (F.lit(y2) > py)
        inside = inside != (crosses & (px < (x2 - x1) * (py - y1) / ((y2 - y1) or 1.0) + x1))
    return inside


def quantised(line: Column, scale: int = K.SCALE) -> Column:
    """Flat array<long>: the first point, then steps, in units of 1/scale, rounded half to even."""
    points = F.transform(line, lambda p: F.struct(F.rint(p["x"] * scale).cast("long").alias("x"), F.rint(p["y"] * scale).cast("long").alias("y")))
    zero = F.struct(F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"))
    before = F.concat(F.array(zero), F.slice(points, F.lit(1), F.greatest(F.size(points) - 1, F.lit(0))))
    return F.flatten(F.zip_with(points, before, lambda a, b: F.array(a["x"] - b["x"], a["y"] - b["y"])))


def dequantised(flat: Column, scale: int = K.SCALE) -> Column:
    """array<struct<x, y>> of what ``quantised`` made."""
    pairs = F.transform(F.sequence(F.lit(0), F.floor(F.size(flat) / 2).cast("int") - 1), lambda i: F.struct(flat[2 * i].alias("x"), flat[2 * i + 1].alias("y")))
    return F.aggregate(
        pairs,
        F.struct(F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), F.array().cast("array<struct<x:double,y:double>>").alias("out")),
        lambda t, p: F.struct((t["x"] + p["x"]).alias("x"), (t["y"] + p["y"]).alias("y"), F.concat(t["out"], F.array(F.struct(((t["x"] + p["x"]) / scale).alias("x"), ((t["y"] + p["y"]) / scale).alias("y")))).alias("out")),
        lambda t: t["out"],
    )


def _six_decimals(x: Column) -> Column:
    """The text of a double with six decimals, of its exact value and ties to even, as C prints it.

    Java rounds the shortest decimal text of the double half up: 0.0078125 becomes 0.007813. Here the fraction is parted into
    its first 26 bits and the rest, whose products with a million are exact, so that the remainder is compared exactly.
    """

    def parted(v: Column) -> Column:
        size = F.abs(v)
        fraction = size - F.floor(size)
        high = F.floor(fraction * 2.0**26) / 2.0**26
        return F.struct(F.floor(size).alias("whole"), (high * 1e6).alias("p"), ((fraction - high) * 1e6).alias("q"))

    def rounded(t: Column) -> Column:
        n = F.floor(t["p"])
        over, rest = t["p"] - n - 0.5, -t["q"]
        up = (over > rest) | ((over == rest) & (n % 2 == 1))
        return F.struct(t["whole"].alias("whole"), (n + F.when(up, 1).otherwise(0)).alias("n"))

    def shown(v: Column, t: Column) -> Column:
        whole = t["whole"] + F.when(t["n"] == 1_000_000, 1).otherwise(0)
        sign = F.when((v < 0) | (v.cast("string") == "-0.0"), "-").otherwise("")
        return F.concat(sign, whole.cast("string"), F.lit("."), F.lpad((t["n"] % 1_000_000).cast("string"), 6, "0"))

    # beyond 2^52 there are no fractions, and a long does not hold all
    return bound(x, lambda v: F.when(F.isnan(v) | (F.abs(v) >= 2.0**52), F.format_string("%.6f", v)).otherwise(bound(bound(parted(v), rounded), lambda t: shown(v, t))))


def wkt(parts: Column) -> Column:
    """Well-known text of the parts of a line, six decimals."""
    point = lambda p: F.concat(_six_decimals(p["x"]), F.lit(" "), _six_decimals(p["y"]))
    rings = F.transform(parts, lambda line: F.concat(F.lit("("), F.array_join(F.transform(line, point), ", "), F.lit(")")))
    return F.when(F.size(parts) == 1, F.concat(F.lit("LINESTRING "), rings[0])).when(F.size(parts) > 1, F.concat(F.lit("MULTILINESTRING ("), F.array_join(rings, ", "), F.lit(")")))
