"""Per-pixel expressions: columns in, a column out. Nodata is NULL."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

WAVELENGTH_M = 0.05546576
# Five-test thresholds, class of each 5-bit diagnostic, cross-calibration (slope, intercept).
WIGT, AWGT, PSWT2 = 0.124, 0.0, -0.5
WATER_CLASS = [0, 0, 0, 2, 0, 2, 2, 1, 3, 3, 3, 1, 3, 1, 1, 1, 4, 4, 4, 2, 4, 2, 2, 1, 3, 3, 3, 1, 3, 1, 1, 1]
CROSS_CALIBRATION = {
    "blue": (0.9778, -0.00411), "green": (1.0053, -0.00093), "red": (0.9765, 0.00094),
    "nir": (0.9983, -0.00029), "swir1": (0.9987, -0.00015), "swir2": (1.0030, -0.00097),
}
CLOUDS = (3, 8, 9, 10)


def f32(x: float) -> Column:
    return F.lit(x).cast("float")


def finite(x: Column) -> Column:
    """NaN and infinities become NULL; done once, on ingest."""
    return F.when(F.isnan(x) | (F.abs(x) == math.inf), None).otherwise(x)


def decibel(power: Column, factor: float = 10.0) -> Column:
    return F.when(power > 0, factor * F.log10(power))


def los_to_vertical(v: Column, incidence_deg: Column) -> Column:
    return F.try_divide(v, F.cos(F.radians(incidence_deg)))


def rate_to_mm(v: Column) -> Column:
    """Phase rate in radians a year to millimetres a year away from the sensor; exact 0 is no measurement."""
    return F.when(v != 0, -v * (WAVELENGTH_M / (4 * math.pi) * 1000))


def offset_reflectance(dn: Column, offset: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(65535), dn + F.coalesce(offset, F.lit(0))))


def cross_calibrated(dn: Column, band: str) -> Column:
    slope, intercept = CROSS_CALIBRATION.get(band, (1.0, 0.0))
    x = dn.cast("float") * f32(slope) + f32(intercept * 10000)
    return F.greatest(f32(0), F.least(f32(65535), x)).cast("int")


def index_bands() -> dict[str, Column]:
    b, g, r, n, s1, s2 = (F.col(c).cast("float") for c in ("blue", "green", "red", "nir", "swir1", "swir2"))
    e = f32(1e-10)
    return {
        "mndwi": (g - s1) / (g + s1 + e), "ndvi": (n - r) / (n + r + e), "mbsrv": g + r, "mbsrn": n + s1,
        "awesh": b + f32(2.5) * g - f32(1.5) * (n + s1) - f32(0.25) * s2,
    }


def diagnostic(wigt: float = WIGT, awgt: float = AWGT, pswt2: float = PSWT2) -> Column:
    """Five tests as bits; needs the index bands as columns."""
    c = F.col
    tests = [
        c("mndwi") > f32(wigt),
        c("mbsrv") > c("mbsrn"),
        c("awesh") > f32(awgt),
        (c("mndwi") > f32(-0.44)) & (c("swir1") < 900) & (c("nir") < 1500) & (c("ndvi") < f32(0.7)),
        (c("mndwi") > f32(pswt2)) & (c("blue") < 1000) & (c("swir1") < 3000) & (c("swir2") < 1000) & (c("nir") < 2500),
    ]
    total = F.lit(0)
    for bit, test in enumerate(tests):
        total = total + test.cast("int") * (1 << bit)
    return total


def water_class(diag: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in WATER_CLASS]), F.greatest(F.lit(0), F.least(F.lit(31), diag)) + 1)


def cloud_masked(cls: Column, scl: Column) -> Column:
    return F.when(scl.isin(*CLOUDS), F.lit(255)).otherwise(cls)


def binary_water(cls: Column) -> Column:
    return F.when(cls.isin(1, 2, 3), 1).when(cls == 255, None).otherwise(0)


def binary_reference_water(jrc: Column) -> Column:
    return F.when(jrc == 1, 0).when(jrc == 2, 1)


def binary_disturbance(status: Column, disturbed: tuple[int, ...] = (2, 3, 4, 5, 6, 7, 8), nodata: tuple[int, ...] = (255,)) -> Column:
    return F.when(status.isin(*disturbed), 1).when(status.isin(*nodata), None).otherwise(0)


def coherence_masked(phase: Column, coh: Column, least: float = 0.3) -> Column:
    return F.when(coh >= least, phase)


def utm_epsg(lon: Column, lat: Column) -> Column:
    """Zone by six degrees, but for south-west Norway and Svalbard."""
    plain = F.least(F.lit(60), F.floor((lon + 180) / 6).cast("int") + 1)
    zone = (
        F.when((lat >= 56) & (lat < 64) & (lon >= 3) & (lon < 12), 32)
        .when((lat >= 72) & (lon >= 0) & (lon < 9), 31)
        .when((lat >= 72) & (lon >= 9) & (lon < 21), 33)
        .when((lat >= 72) & (lon >= 21) & (lon < 33), 35)
        .when((lat >= 72) & (lon >= 33) & (lon < 42), 37)
        .otherwise(plain)
    )
    return F.when(lat >= 0, 32600 + zone).otherwise(32700 + zone)


def ten_degree_tile(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Column and row of the tile whose pixel offsets count from (-180, 80); truncated."""
    return ((lon + 180) / 10).cast("int"), ((80 - lat) / 10).cast("int")


def land_cover_tile(lon: Column, lat: Column) -> Column:
    y, x = (F.floor(lat / 3) * 3).cast("int"), (F.floor(lon / 3) * 3).cast("int")
    ns, ew = F.when(y >= 0, "N").otherwise("S"), F.when(x >= 0, "E").otherwise("W")
    return F.concat(ns, F.lpad(F.abs(y).cast("string"), 2, "0"), ew, F.lpad(F.abs(x).cast("string"), 3, "0"))


def track(lon: Column) -> Column:
    return ((lon + 180) * 175 / 360).cast("int") % 175 + 1


def stable_point_ceiling(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Points expected in a box: 300 a square kilometre, three tenths of them stable."""
    width = (east - west) * 111 * F.cos(F.radians((south + north) / 2))
    return (width * (north - south) * 111 * 300 * 0.3).cast("long")
