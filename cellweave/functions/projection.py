"""Closed-form projections: geographic, Web Mercator and UTM zone 22 south."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spheres, ellipsoid and zone parameters of the three systems.
MERCATOR_RADIUS = 6378137.0
MERCATOR_HALF_WORLD = 20037508.342789244
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_SCALE = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_SOUTH_FALSE_NORTHING = 10000000.0
ZONE_22_MERIDIAN = -51.0

_N = WGS84_F / (2 - WGS84_F)
RECTIFYING_RADIUS = WGS84_A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
CONFORMAL_FACTOR = 2 * _N**0.5 / (1 + _N)
# Coefficients of the Kruger series in the third flattening, to fourth order.
ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """EPSG:4326 to EPSG:3857."""
    x = F.lit(MERCATOR_RADIUS) * F.radians(lon)
    y = F.lit(MERCATOR_RADIUS) * F.log(F.tan(F.pi() / 4 + F.radians(lat) / 2))
    return x, y


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    """EPSG:3857 to EPSG:4326."""
    lon = F.degrees(x / F.lit(MERCATOR_RADIUS))
    lat = F.degrees(2 * F.atan(F.exp(y / F.lit(MERCATOR_RADIUS))) - F.pi() / 2)
    return lon, lat


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once for all its uses in ``body``; keeps long series short."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def to_utm22s(lon: Column, lat: Column) -> tuple[Column, Column]:
    """EPSG:4326 to EPSG:32722, Kruger series."""

    def conformal(p: Column) -> Column:
        t = F.sinh(F.atanh(p["s"]) - F.lit(CONFORMAL_FACTOR) * F.atanh(F.lit(CONFORMAL_FACTOR) * p["s"]))
        return F.struct(t.alias("t"), p["a"].alias("a"))

    def sphere(p: Column) -> Column:
        xi = F.atan2(p["t"], F.cos(p["a"]))
        eta = F.atanh(F.sin(p["a"]) / F.sqrt(1 + p["t"] * p["t"]))
        return F.struct(xi.alias("xi"), eta.alias("eta"))

    def plane(p: Column) -> Column:
        xi, eta = p["xi"], p["eta"]
        for j, a in enumerate(ALPHA, start=1):
            xi = xi + F.lit(a) * F.sin(2 * j * p["xi"]) * F.cosh(2 * j * p["eta"])
            eta = eta + F.lit(a) * F.cos(2 * j * p["xi"]) * F.sinh(2 * j * p["eta"])
        k = F.lit(UTM_SCALE * RECTIFYING_RADIUS)
        return F.struct(
            (F.lit(UTM_FALSE_EASTING) + k * eta).alias("e"), (F.lit(UTM_SOUTH_FALSE_NORTHING) + k * xi).alias("n")
        )

    start = F.struct(F.sin(F.radians(lat)).alias("s"), F.radians(lon - F.lit(ZONE_22_MERIDIAN)).alias("a"))
    at = _let(_let(_let(start, conformal), sphere), plane)
    return at["e"], at["n"]


def from_utm22s(e: Column, n: Column) -> tuple[Column, Column]:
    """EPSG:32722 to EPSG:4326."""

    def sphere(p: Column) -> Column:
        xi, eta = p["xi"], p["eta"]
        for j, b in enumerate(BETA, start=1):
            xi = xi - F.lit(b) * F.sin(2 * j * p["xi"]) * F.cosh(2 * j * p["eta"])
            eta = eta - F.lit(b) * F.cos(2 * j * p["xi"]) * F.sinh(2 * j * p["eta"])
        return F.struct(xi.alias("xi"), eta.alias("eta"))

    def conformal(p: Column) -> Column:
        lon = F.lit(ZONE_22_MERIDIAN) + F.degrees(F.atan2(F.sinh(p["eta"]), F.cos(p["xi"])))
        return F.struct(lon.alias("lon"), F.asin(F.sin(p["xi"]) / F.cosh(p["eta"])).alias("chi"))

    def ellipsoid(p: Column) -> Column:
        lat = p["chi"]
        for j, d in enumerate(DELTA, start=1):
            lat = lat + F.lit(d) * F.sin(2 * j * p["chi"])
        return F.struct(p["lon"].alias("lon"), F.degrees(lat).alias("lat"))

    k = F.lit(UTM_SCALE * RECTIFYING_RADIUS)
    start = F.struct(
        ((n - F.lit(UTM_SOUTH_FALSE_NORTHING)) / k).alias("xi"), ((e - F.lit(UTM_FALSE_EASTING)) / k).alias("eta")
    )
    at = _let(_let(_let(start, sphere), conformal), ellipsoid)
    return at["lon"], at["lat"]


def utm22s_to_mercator(e: Column, n: Column) -> tuple[Column, Column]:
    """EPSG:32722 to EPSG:3857."""
    return to_mercator(*from_utm22s(e, n))


def mercator_to_utm22s(x: Column, y: Column) -> tuple[Column, Column]:
    """EPSG:3857 to EPSG:32722."""
    return to_utm22s(*from_mercator(x, y))


def _same(x: Column, y: Column) -> tuple[Column, Column]:
    return x, y


GEOGRAPHIC = "EPSG:4326"
WEB_MERCATOR = "EPSG:3857"
UTM_22S = "EPSG:32722"

TRANSFORMS = {
    (GEOGRAPHIC, WEB_MERCATOR): to_mercator,
    (WEB_MERCATOR, GEOGRAPHIC): from_mercator,
    (GEOGRAPHIC, UTM_22S): to_utm22s,
    (UTM_22S, GEOGRAPHIC): from_utm22s,
    (UTM_22S, WEB_MERCATOR): utm22s_to_mercator,
    (WEB_MERCATOR, UTM_22S): mercator_to_utm22s,
}


def transform(source: str, target: str):
    """The column transform between two systems."""
    if source == target:
        return _same
    if (source, target) not in TRANSFORMS:
        raise ValueError(f"no transform from {source} to {target}")
    return TRANSFORMS[(source, target)]


def is_separable(source: str, target: str) -> bool:
    """Whether x depends on x alone and y on y alone."""
    return UTM_22S not in (source, target) or source == target
