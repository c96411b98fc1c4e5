"""Geo functions: point parsing, place centres, spherical mean."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rounding of centres and the "no direction" cut-off for the
# mean vector (antipodal inputs average to the zero vector).
CENTRE_DECIMALS = 6
ZERO_VECTOR_EPS = 1e-12

POINT_SCHEMA = "struct<type:string, coordinates:array<double>>"
PLACE_SCHEMA = "struct<id:string, bounding_box:struct<type:string, coordinates:array<array<array<double>>>>>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unit_vector(lat, lon) -> list[Column]:
    """(x, y, z) of a lat/lon in degrees on the unit sphere."""
    la, lo = F.radians(_c(lat)), F.radians(_c(lon))
    return [F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)]


def centre_from_vector(x, y, z) -> Column:
    """struct(lat, lon) of a (summed or mean) vector; null for a zero vector.

    Rounded to 6 decimals; -0.0 becomes 0.0 and a longitude of -180 is
    reported as 180.
    """
    x, y, z = _c(x), _c(y), _c(z)
    hyp = F.sqrt(x * x + y * y)
    lat = F.round(F.degrees(F.atan2(z, hyp)), CENTRE_DECIMALS) + F.lit(0.0)
    lon = F.round(F.degrees(F.atan2(y, x)), CENTRE_DECIMALS) + F.lit(0.0)
    lon = F.when(lon == -180.0, F.lit(180.0)).otherwise(lon)
    zero = (hyp < ZERO_VECTOR_EPS) & (F.abs(z) < ZERO_VECTOR_EPS)
    return F.when(zero, F.lit(None)).otherwise(F.struct(lat.alias("lat"), lon.alias("lon")))


def centre_aggs(lat, lon, prefix: str = "_c") -> list[Column]:
    """Aggregate expressions summing unit vectors; finish with ``centre_from_vector``.

    Sums are partial-aggregated map-side, so any number of points per key is fine.
    """
    x, y, z = unit_vector(lat, lon)
    return [F.sum(x).alias(f"{prefix}x"), F.sum(y).alias(f"{prefix}y"), F.sum(z).alias(f"{prefix}z")]


def geo_center(points) -> Column:
    """F10 on an array<struct<lat,lon>> column (small per-row arrays)."""
    p = _c(points)
    vec = F.aggregate(
        p,
        F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("z")),
        lambda acc, q: F.struct(
            (acc["x"] + unit_vector(q["lat"], q["lon"])[0]).alias("x"),
            (acc["y"] + unit_vector(q["lat"], q["lon"])[1]).alias("y"),
            (acc["z"] + unit_vector(q["lat"], q["lon"])[2]).alias("z"),
        ),
    )
    return F.when(F.size(p) > 0, centre_from_vector(vec["x"], vec["y"], vec["z"]))


def geo_point(text, coord_order: str = "lonlat") -> Column:
    """parse a Point; blank, ``{}``, bad JSON, other types or not exactly
    two coordinates → null. ``coord_order`` = "lonlat" (GeoJSON) or "latlon"
    (the tweet ``geo`` field); there is no silent swap (Q7)."""
    j = F.from_json(_c(text), POINT_SCHEMA)
    c = j["coordinates"]
    ok = (j["type"] == "Point") & (F.size(c) == 2) & c[0].isNotNull() & c[1].isNotNull()
    lat, lon = (c[1], c[0]) if coord_order == "lonlat" else (c[0], c[1])
    return F.when(ok, F.struct(lat.alias("lat"), lon.alias("lon")))


def bbox_center(place_json) -> Column:
    """centre of the 4 corners of a Polygon place bounding box; other types → null."""
    p = F.from_json(_c(place_json), PLACE_SCHEMA)
    ring = p["bounding_box"]["coordinates"][0]
    ok = (p["bounding_box"]["type"] == "Polygon") & (F.size(ring) >= 4)
    corners = F.transform(F.slice(ring, 1, 4), lambda q: F.struct(q[1].alias("lat"), q[0].alias("lon")))
    return F.when(ok, geo_center(corners))


def in_bbox(lat, lon, box: tuple[float, float, float, float]) -> Column:
    """F16: point inside a box given as (west lon, south lat, east lon, north lat)."""
    w, s, e, n = box
    return _c(lat).between(s, n) & _c(lon).between(w, e)
