"""Transverse Mercator on WGS84 as closed-form column expressions (Krüger series, 4 terms)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldlens.functions import shapes

# WGS84 ellipsoid and UTM scale.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
SCALE = 0.9996
FALSE_EASTING = 500000.0

_N = FLATTENING / (2 - FLATTENING)
_RECT = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
_DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)
_E = 2 * _N**0.5 / (1 + _N)


def central_meridian(srid: int) -> float:
    """Central meridian of a northern UTM zone given as EPSG 326xx."""
    if not 32601 <= srid <= 32660:
        raise ValueError(f"srid {srid} is not a northern UTM zone")
    return (srid - 32600) * 6 - 183.0


def to_utm(lon: Column, lat: Column, srid: int = 32634) -> Column:
    """Easting and northing in metres as a point struct."""
    phi, lam = F.radians(lat), F.radians(lon - F.lit(central_meridian(srid)))
    t = F.sinh(F.atanh(F.sin(phi)) - F.lit(_E) * F.atanh(F.lit(_E) * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        x = x + F.lit(a) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + F.lit(a) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    k = F.lit(SCALE * _RECT)
    return shapes.point(F.lit(FALSE_EASTING) + k * x, k * y)


def from_utm(x: Column, y: Column, srid: int = 32634) -> Column:
    """Longitude and latitude in degrees as a point struct."""
    k = F.lit(SCALE * _RECT)
    xi0, eta0 = y / k, (x - F.lit(FALSE_EASTING)) / k
    xi, eta = xi0, eta0
    for j, b in enumerate(_BETA, 1):
        xi = xi - F.lit(b) * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0)
        eta = eta - F.lit(b) * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    phi = chi
    for j, d in enumerate(_DELTA, 1):
        phi = phi + F.lit(d) * F.sin(2 * j * chi)
    lam = F.atan2(F.sinh(eta), F.cos(xi))
    return shapes.point(F.degrees(lam) + F.lit(central_meridian(srid)), F.degrees(phi))


def reproject(shape: Column, source: int, target: int) -> Column:
    """Move a shape between EPSG 4326 and a northern UTM zone."""
    if source == target:
        return shape
    if source == 4326:
        return shapes.map_points(shape, lambda p: to_utm(p["x"], p["y"], target))
    if target == 4326:
        return shapes.map_points(shape, lambda p: from_utm(p["x"], p["y"], source))
    return reproject(reproject(shape, source, 4326), 4326, target)
