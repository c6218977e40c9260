"""Map projections as column expressions: transverse Mercator zones and the European equal-area grid, both ways."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Semi-axes and inverse flattenings, scale, false origins.
MAJOR = 6378137.0
WGS84, GRS80 = 1 / 298.257223563, 1 / 298.257222101
SCALE, FALSE_EAST, FALSE_NORTH_SOUTH = 0.9996, 500000.0, 10000000.0
LAEA_LON, LAEA_LAT, LAEA_EAST, LAEA_NORTH = 10.0, 52.0, 4321000.0, 3210000.0


def _powers(n: float, rows: list[list[float]]) -> list[float]:
    """Row j holds the coefficients of n ** j, n ** (j + 1), ..."""
    return [sum(c * n ** (j + k) for k, c in enumerate(row)) for j, row in enumerate(rows, 1)]


_N = WGS84 / (2 - WGS84)
_RADIUS = SCALE * MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Series of the transverse Mercator projection in the third flattening, to its fourth power.
_TO_GRID = _powers(_N, [[1 / 2, -2 / 3, 5 / 16, 41 / 180], [13 / 48, -3 / 5, 557 / 1440], [61 / 240, -103 / 140], [49561 / 161280]])
_FROM_GRID = _powers(_N, [[1 / 2, -2 / 3, 37 / 96, -1 / 360], [1 / 48, 1 / 15, -437 / 1440], [17 / 480, -37 / 840], [4397 / 161280]])
_TO_LATITUDE = _powers(_N, [[2, -2 / 3, -2, 116 / 45], [7 / 3, -8 / 5, -227 / 45], [56 / 15, -136 / 35], [4279 / 630]])


def _sum(series: list[float], term) -> Column:
    out = F.lit(0.0)
    for j, c in enumerate(series, 1):
        out = out + F.lit(c) * term(2 * j)
    return out


def _central(zone: Column) -> Column:
    return zone * 6 - 183


def to_utm(lon: Column, lat: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """Easting and northing in a zone; on the southern half northings count from ten million."""
    s, l = F.sin(F.radians(lat)), F.radians(lon - _central(zone))
    k = 2 * math.sqrt(_N) / (1 + _N)
    t = F.sinh(F.atanh(s) - F.lit(k) * F.atanh(F.lit(k) * s))
    xi, eta = F.atan2(t, F.cos(l)), F.atanh(F.sin(l) / F.sqrt(1 + t * t))
    east = eta + _sum(_TO_GRID, lambda j: F.cos(j * xi) * F.sinh(j * eta))
    north = xi + _sum(_TO_GRID, lambda j: F.sin(j * xi) * F.cosh(j * eta))
    return F.lit(_RADIUS) * east + FALSE_EAST, F.lit(_RADIUS) * north + F.when(south, FALSE_NORTH_SOUTH).otherwise(0.0)


def from_utm(east: Column, north: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """Longitude and latitude."""
    x = (north - F.when(south, FALSE_NORTH_SOUTH).otherwise(0.0)) / _RADIUS
    e = (east - FALSE_EAST) / _RADIUS
    xi = x - _sum(_FROM_GRID, lambda j: F.sin(j * x) * F.cosh(j * e))
    eta = e - _sum(_FROM_GRID, lambda j: F.cos(j * x) * F.sinh(j * e))
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    lat = chi + _sum(_TO_LATITUDE, lambda j: F.sin(j * chi))
    return _central(zone) + F.degrees(F.atan2(F.sinh(eta), F.cos(xi))), F.degrees(lat)


_E2 = GRS80 * (2 - GRS80)
_E = math.sqrt(_E2)


def _authalic(s: float) -> float:
    return (1 - _E2) * (s / (1 - _E2 * s * s) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


_POLE = _authalic(1.0)
_ORIGIN = math.asin(_authalic(math.sin(math.radians(LAEA_LAT))) / _POLE)
_EQUAL = MAJOR * math.sqrt(_POLE / 2)
_STRETCH = MAJOR * math.cos(math.radians(LAEA_LAT)) / (math.sqrt(1 - _E2 * math.sin(math.radians(LAEA_LAT)) ** 2) * _EQUAL * math.cos(_ORIGIN))
_G = GRS80 / (2 - GRS80)
# From the authalic latitude to the geographic one, a series in the third flattening to its fourth power.
_FROM_AUTHALIC = _powers(_G, [[4 / 3, 4 / 45, -16 / 35, -2582 / 14175], [46 / 45, 152 / 945, -11966 / 14175], [3044 / 2835, 3802 / 14175], [6059 / 4725]])


def to_laea(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing on the European equal-area grid (EPSG:3035)."""
    s, l = F.sin(F.radians(lat)), F.radians(lon - LAEA_LON)
    q = F.lit(1 - _E2) * (s / (1 - F.lit(_E2) * s * s) - F.log((1 - F.lit(_E) * s) / (1 + F.lit(_E) * s)) / F.lit(2 * _E))
    beta = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), q / _POLE)))
    s1, c1 = math.sin(_ORIGIN), math.cos(_ORIGIN)
    b = F.lit(_EQUAL) * F.sqrt(2 / (1 + s1 * F.sin(beta) + c1 * F.cos(beta) * F.cos(l)))
    east = b * F.lit(_STRETCH) * F.cos(beta) * F.sin(l)
    north = b / F.lit(_STRETCH) * (c1 * F.sin(beta) - s1 * F.cos(beta) * F.cos(l))
    return east + LAEA_EAST, north + LAEA_NORTH


def from_laea(east: Column, north: Column) -> tuple[Column, Column]:
    """Longitude and latitude (EPSG:3035 to EPSG:4326)."""
    x, y = (east - LAEA_EAST) / _STRETCH, (north - LAEA_NORTH) * _STRETCH
    rho = F.sqrt(x * x + y * y)
    c = 2 * F.asin(F.least(F.lit(1.0), rho / (2 * _EQUAL)))
    s1, c1 = math.sin(_ORIGIN), math.cos(_ORIGIN)
    sine = F.cos(c) * s1 + F.when(rho == 0, 0.0).otherwise(y * F.sin(c) * c1 / F.nullif(rho, F.lit(0.0)))
    beta = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sine)))
    turn = F.when(rho == 0, 0.0).otherwise(F.atan2(x * F.sin(c), rho * c1 * F.cos(c) - y * s1 * F.sin(c)))
    lat = beta + _sum(_FROM_AUTHALIC, lambda j: F.sin(j * beta))
    return F.degrees(turn) + LAEA_LON, F.degrees(lat)
