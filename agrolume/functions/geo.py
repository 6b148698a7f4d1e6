"""Bounding boxes, ellipsoidal area, map projections, tile numbers.

Projections are the published Krüger series (order 4) for transverse Mercator
and the spherical web-Mercator formulas. Ellipsoidal areas integrate the
authalic function exactly along meridians and linearly along edges, which is
exact for latitude/longitude rectangles. Geodesic edges would differ by 2.6e-5
of the area for a one-degree cell and 5e-8 for a 5 km field. The Krüger round
trip closes below 1e-9 degrees (both measured in tests/test_spatial.py).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from agrolume.functions import polygons as poly

# The WGS84 ellipsoid.
A_METRES = 6378137.0
FLATTENING = 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)
E = math.sqrt(E2)

# Krüger series in the third flattening n, published coefficients.
_N = FLATTENING / (2 - FLATTENING)
_RECTIFYING = A_METRES / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
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
_SCALE = 0.9996
_FALSE_EAST = 500000.0
_FALSE_NORTH_SOUTH = 10000000.0


def normalise_bbox(box: Column) -> Column:
    """[west, a, east, b] with the two latitudes put in order; NULL if unusable."""
    good = (F.size(box) == 4) & (box[0] < box[2])
    return F.when(good, F.array(box[0], F.least(box[1], box[3]), box[2], F.greatest(box[1], box[3])))


def bbox_intersection(a: Column, b: Column) -> Column:
    west, south = F.greatest(a[0], b[0]), F.greatest(a[1], b[1])
    east, north = F.least(a[2], b[2]), F.least(a[3], b[3])
    return F.when((west < east) & (south < north), F.array(west, south, east, north))


def bbox_area(box: Column) -> Column:
    size = F.greatest(box[2] - box[0], F.lit(0.0)) * F.greatest(box[3] - box[1], F.lit(0.0))
    return F.coalesce(size, F.lit(0.0))


def authalic_q(lat_degrees: Column) -> Column:
    """The authalic function q of a geodetic latitude."""
    s = F.sin(F.radians(lat_degrees))
    return F.lit(1 - E2) * (s / (F.lit(1.0) - s * s * E2) + F.atanh(s * E) / E)


def equal_area(polygons: Column) -> Column:
    """The polygon with y replaced by q(lat) and x by radians of longitude."""

    def point(v: Column) -> Column:
        return poly.vertex(F.radians(v["x"]), authalic_q(v["y"]))

    return F.transform(polygons, lambda p: F.transform(p, lambda r: F.transform(r, point)))


def area_km2(polygons: Column) -> Column:
    """Ellipsoidal area of a longitude/latitude polygon in square kilometres."""
    return poly.area(equal_area(polygons)) * F.lit(A_METRES * A_METRES / 2 / 1e6)


def utm_zone(lon: Column) -> Column:
    return F.least(F.lit(60), F.greatest(F.lit(1), (F.floor((lon + 180.0) / 6.0) + 1).cast("int")))


def utm_epsg(lon: Column, lat: Column) -> Column:
    return F.when(lat >= 0, 32600).otherwise(32700) + utm_zone(lon)


def _central_meridian(zone: Column) -> Column:
    return F.radians((zone * 6 - 183).cast("double"))


def _series(coefficients: tuple[float, ...], xi: Column, eta: Column, along: str) -> Column:
    total = F.lit(0.0)
    for j, value in enumerate(coefficients, start=1):
        k = 2.0 * j
        if along == "east":
            term = F.cos(xi * k) * F.sinh(eta * k)
        else:
            term = F.sin(xi * k) * F.cosh(eta * k)
        total = total + term * value
    return total


def utm_forward(lon: Column, lat: Column, zone: Column) -> tuple[Column, Column]:
    """(easting, northing) in metres."""
    s = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(s) - F.atanh(s * E) * E)
    dl = F.radians(lon) - _central_meridian(zone)
    xi = F.atan2(t, F.cos(dl))
    eta = F.atanh(F.sin(dl) / F.sqrt(t * t + 1.0))
    east = (eta + _series(_ALPHA, xi, eta, "east")) * (_SCALE * _RECTIFYING) + _FALSE_EAST
    north = (xi + _series(_ALPHA, xi, eta, "north")) * (_SCALE * _RECTIFYING)
    return east, F.when(lat < 0, north + _FALSE_NORTH_SOUTH).otherwise(north)


def utm_inverse(east: Column, north: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """(lon, lat) in degrees."""
    xi = (north - F.when(south, _FALSE_NORTH_SOUTH).otherwise(0.0)) / (_SCALE * _RECTIFYING)
    eta = (east - _FALSE_EAST) / (_SCALE * _RECTIFYING)
    xi_p = xi - _series(_BETA, xi, eta, "north")
    eta_p = eta - _series(_BETA, xi, eta, "east")
    chi = F.asin(F.sin(xi_p) / F.cosh(eta_p))
    phi = chi
    for j, value in enumerate(_DELTA, start=1):
        phi = phi + F.sin(chi * (2.0 * j)) * value
    lam = _central_meridian(zone) + F.atan2(F.sinh(eta_p), F.cos(xi_p))
    return F.degrees(lam), F.degrees(phi)


def web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lon) * A_METRES, F.asinh(F.tan(F.radians(lat))) * A_METRES


def slippy_tile(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """Tile x, y at a zoom level; latitude is clamped to the map's edge."""
    scale = float(2**zoom)
    clamped = F.least(F.greatest(lat, F.lit(-85.0511)), F.lit(85.0511))
    x = ((lon + 180.0) / 360.0 * scale).cast("int")
    y = ((F.lit(1.0) - F.asinh(F.tan(F.radians(clamped))) / math.pi) / 2.0 * scale).cast("int")
    return x, y
