"""Lines as arrays of parts, each an array of points (x, y); parsing, projection, lengths and distances by array functions.

Points and polygons, and texts that can't be parsed, are null; multi-part lines work everywhere.
"""

from __future__ import annotations

from collections.abc import Callable
from math import cos, log, radians, sin, sqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

LINES = "array<array<struct<x:double,y:double>>>"
_NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
_POINT = rf"\s*{_NUMBER}\s+{_NUMBER}(?:\s+{_NUMBER})?\s*"
_PART = rf"\(\s*{_POINT}(?:,{_POINT})+\)"
_LINE = rf"(?i)^\s*LINESTRING(?:\s+Z)?\s*{_PART}\s*$"
_LINES = rf"(?i)^\s*MULTILINESTRING(?:\s+Z)?\s*\(\s*{_PART}(?:\s*,\s*{_PART})*\s*\)\s*$"

# NAD83 / Texas Centric Albers Equal Area (EPSG:3083), in metres.
MAJOR, FLATTENING = 6378137.0, 1 / 298.257222101
LAT_1, LAT_2, LAT_0, LON_0 = 27.5, 35.0, 18.0, -100.0
FALSE_EAST, FALSE_NORTH = 1_500_000.0, 6_000_000.0
US_FOOT = 1200 / 3937


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once for each row, however often it is named; array functions share nothing by themselves."""
    return F.transform(F.array(value), use)[0]


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def parse_lines(text: Column) -> Column:
    """WKT or GeoJSON lines."""
    shape = F.regexp_replace(F.regexp_extract(text, r"(?s)\((.*)\)", 1), r"^\s*\(|\)\s*$", "")
    vertex = lambda v: _once(F.split(F.trim(v), r"\s+"), lambda n: _point(n[0].cast("double"), n[1].cast("double")))
    wkt = F.transform(F.split(shape, r"\)\s*,\s*\("), lambda part: F.transform(F.split(part, ","), vertex))
    pair = lambda c: _point(c[0], c[1])
    kind = F.get_json_object(text, "$.type")
    coordinates = F.get_json_object(text, "$.coordinates")
    one = F.array(F.transform(F.from_json(coordinates, "array<array<double>>"), pair))
    many = F.transform(F.from_json(coordinates, "array<array<array<double>>>"), lambda part: F.transform(part, pair))
    json = _once(kind, lambda k: F.when(k == "LineString", one).when(k == "MultiLineString", many))
    full = lambda p: (F.size(p) > 1) & F.forall(p, lambda v: v["x"].isNotNull() & v["y"].isNotNull())
    whole = lambda j: F.coalesce(F.size(j) > 0, F.lit(False)) & F.coalesce(F.forall(j, full), F.lit(False))
    return F.when(F.trim(text).startswith("{"), _once(json, lambda j: F.when(whole(j), j))).when(text.rlike(_LINE) | text.rlike(_LINES), wkt)


def _albers() -> tuple[float, float, float, float]:
    e2 = FLATTENING * (2 - FLATTENING)
    e = sqrt(e2)

    def q(lat: float) -> float:
        s = sin(radians(lat))
        return (1 - e2) * (s / (1 - e2 * s * s) - log((1 - e * s) / (1 + e * s)) / (2 * e))

    def m(lat: float) -> float:
        return cos(radians(lat)) / sqrt(1 - e2 * sin(radians(lat)) ** 2)

    n = (m(LAT_1) ** 2 - m(LAT_2) ** 2) / (q(LAT_2) - q(LAT_1))
    c = m(LAT_1) ** 2 + n * q(LAT_1)
    return e, n, c, MAJOR * sqrt(c - n * q(LAT_0)) / n


E, N, C, RHO_0 = _albers()


def project_point(p: Column) -> Column:
    """Longitude and latitude to the plane (Snyder, Map Projections, ellipsoidal Albers)."""
    q = lambda s: (1 - E * E) * (s / (1 - E * E * s * s) - F.log((1 - E * s) / (1 + E * s)) / (2 * E))
    polar = F.struct(_once(F.sin(F.radians(p["y"])), lambda s: MAJOR * F.sqrt(C - N * q(s)) / N).alias("rho"), (N * F.radians(p["x"] - LON_0)).alias("theta"))
    return _once(polar, lambda r: _point(FALSE_EAST + r["rho"] * F.sin(r["theta"]), FALSE_NORTH + RHO_0 - r["rho"] * F.cos(r["theta"])))


def project(lines: Column) -> Column:
    return F.transform(lines, lambda part: F.transform(part, project_point))


def segments(lines: Column) -> Column:
    """Array of (a, b, length) of all parts."""
    pair = lambda a, b: F.struct(a.alias("a"), b.alias("b"), distance(a, b).alias("length"))
    return F.flatten(F.transform(lines, lambda p: F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1), pair)))


def distance(a: Column, b: Column) -> Column:
    return F.hypot(a["x"] - b["x"], a["y"] - b["y"])


def _total(pieces: Column) -> Column:
    return F.aggregate(pieces, F.lit(0.0), lambda t, s: t + s["length"])


def length(lines: Column) -> Column:
    return _total(segments(lines))


def first_point(lines: Column) -> Column:
    return F.element_at(F.element_at(lines, 1), 1)


def last_point(lines: Column) -> Column:
    return F.element_at(F.element_at(lines, -1), -1)


def midpoint(lines: Column) -> Column:
    """The point halfway along the line."""

    def step(t: Column, s: Column) -> Column:
        here = ~t["done"] & (t["rest"] <= s["length"])
        share = F.coalesce(F.try_divide(t["rest"], s["length"]), F.lit(0.0))
        along = lambda k: F.when(here, s["a"][k] + share * (s["b"][k] - s["a"][k])).when(~t["done"], s["b"][k]).otherwise(t[k])
        return F.struct(F.when(t["done"] | here, t["rest"]).otherwise(t["rest"] - s["length"]).alias("rest"), along("x").alias("x"), along("y").alias("y"), (t["done"] | here).alias("done"))

    def halfway(line: Column) -> Column:
        first, pieces = line["first"], line["pieces"]
        start = F.struct((_total(pieces) / 2).alias("rest"), first["x"].alias("x"), first["y"].alias("y"), F.lit(False).alias("done"))
        return F.aggregate(pieces, start, step, lambda t: _point(t["x"], t["y"]))

    return F.when(lines.isNotNull(), _once(F.struct(first_point(lines).alias("first"), segments(lines).alias("pieces")), halfway))


def point_piece_distance(p: Column, a: Column, b: Column) -> Column:
    """Distance of a point to the nearest point of the straight piece from a to b."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    t = F.coalesce(F.try_divide((p["x"] - a["x"]) * dx + (p["y"] - a["y"]) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return F.hypot(p["x"] - (a["x"] + t * dx), p["y"] - (a["y"] + t * dy))


def point_line_distance(p: Column, lines: Column) -> Column:
    """Distance of a point to the nearest point of a line."""
    return F.array_min(F.transform(segments(lines), lambda s: point_piece_distance(p, s["a"], s["b"])))
