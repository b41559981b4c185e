"""Swiss grid LV95 (EPSG:2056) -> WGS84 as column expressions.

``lv95_to_wgs84`` follows the rigorous formulas: the inverse of the oblique
conformal Mercator projection (plane -> sphere -> Bessel ellipsoid), then the
datum shift by three geocentric translations. It agrees with a projection
library to fractions of a millimetre in the plane; the height, unknown here,
is taken as that of the ellipsoid. ``lv95_to_wgs84_approx`` is the published
polynomial, good to about a metre.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the Swiss projection: Bessel 1841 axis and squared
# eccentricity, the origin (old observatory of Bern: 46 57 08.66 N,
# 7 26 22.50 E), its false coordinates, and the shift to WGS84 in metres.
BESSEL_A, BESSEL_E2 = 6377397.155, 0.006674372230614
LAT0, LON0 = math.radians(46 + 57 / 60 + 8.66 / 3600), math.radians(7 + 26 / 60 + 22.5 / 3600)
E0, N0 = 2600000.0, 1200000.0
SHIFT = (674.374, 15.056, 405.346)
# WGS84 axis and flattening.
WGS_A, WGS_F = 6378137.0, 1 / 298.257223563

# Derived: radius of the sphere, ratio of longitudes, latitude of the origin
# on the sphere, constant of the latitude's image.
_E = math.sqrt(BESSEL_E2)
_R = BESSEL_A * math.sqrt(1 - BESSEL_E2) / (1 - BESSEL_E2 * math.sin(LAT0) ** 2)
_ALPHA = math.sqrt(1 + BESSEL_E2 / (1 - BESSEL_E2) * math.cos(LAT0) ** 4)
_B0 = math.asin(math.sin(LAT0) / _ALPHA)


def _isometric(lat: float) -> float:
    return math.log(math.tan(math.pi / 4 + lat / 2)) - _E / 2 * math.log((1 + _E * math.sin(lat)) / (1 - _E * math.sin(lat)))


_K = math.log(math.tan(math.pi / 4 + _B0 / 2)) - _ALPHA * _isometric(LAT0)
#: Rounds of the latitude's fixed point; each gains two to three digits.
ROUNDS = 6


def lv95_to_bessel(easting: Column, northing: Column) -> tuple[Column, Column]:
    """(latitude, longitude) in radians on the Bessel ellipsoid."""
    l_bar = (easting.cast("double") - F.lit(E0)) / F.lit(_R)
    b_bar = 2 * F.atan(F.exp((northing.cast("double") - F.lit(N0)) / F.lit(_R))) - F.lit(math.pi / 2)
    # from the sphere around the projection's equator to the sphere around the earth's
    sin_b = F.lit(math.cos(_B0)) * F.sin(b_bar) + F.lit(math.sin(_B0)) * F.cos(b_bar) * F.cos(l_bar)
    lon = F.lit(LON0) + F.atan(F.sin(l_bar) / (F.lit(math.cos(_B0)) * F.cos(l_bar) - F.lit(math.sin(_B0)) * F.tan(b_bar))) / F.lit(_ALPHA)
    b = F.asin(sin_b)
    q = (F.log(F.tan(F.lit(math.pi / 4) + b / 2)) - F.lit(_K)) / F.lit(_ALPHA)
    lat = b
    for _ in range(ROUNDS):                          # the latitude stands once in each round: the expression stays short
        lat = 2 * F.atan(F.exp(q + F.lit(_E) * F.atanh(F.lit(_E) * F.sin(lat)))) - F.lit(math.pi / 2)
    return lat, lon


def lv95_to_wgs84(easting: Column, northing: Column) -> tuple[Column, Column]:
    """Return (latitude, longitude) in degrees."""
    lat, lon = lv95_to_bessel(easting, northing)
    radius = F.lit(BESSEL_A) / F.sqrt(1 - F.lit(BESSEL_E2) * F.pow(F.sin(lat), F.lit(2.0)))
    x = radius * F.cos(lat) * F.cos(lon) + F.lit(SHIFT[0])
    y = radius * F.cos(lat) * F.sin(lon) + F.lit(SHIFT[1])
    z = radius * F.lit(1 - BESSEL_E2) * F.sin(lat) + F.lit(SHIFT[2])
    # geocentric -> geodetic in closed form (Bowring), exact to 1e-11 degrees near the ground
    e2 = WGS_F * (2 - WGS_F)
    b = WGS_A * (1 - WGS_F)
    p = F.hypot(x, y)
    theta = F.atan2(z * F.lit(WGS_A), p * F.lit(b))
    up = z + F.lit(e2 / (1 - e2) * b) * F.pow(F.sin(theta), F.lit(3.0))
    out = p - F.lit(e2 * WGS_A) * F.pow(F.cos(theta), F.lit(3.0))
    return F.degrees(F.atan2(up, out)), F.degrees(F.atan2(y, x))


# Coefficients of the published LV95 -> WGS84 approximation.
# Auxiliary values: y = (E - 2600000) / 1e6, x = (N - 1200000) / 1e6
# lon' = 2.6779094 + 4.728982 y + 0.791484 y x + 0.1306 y x^2 - 0.0436 y^3
# lat' = 16.9023892 + 3.238272 x - 0.270978 y^2 - 0.002528 x^2
#        - 0.0447 y^2 x - 0.0140 x^3
# lon = lon' * 100 / 36, lat = lat' * 100 / 36
def lv95_to_wgs84_approx(easting: Column, northing: Column) -> tuple[Column, Column]:
    """(latitude, longitude) in degrees by the polynomial."""
    y = (easting.cast("double") - F.lit(E0)) / F.lit(1e6)
    x = (northing.cast("double") - F.lit(N0)) / F.lit(1e6)
    lon = (F.lit(2.6779094) + F.lit(4.728982) * y + F.lit(0.791484) * y * x
           + F.lit(0.1306) * y * x * x - F.lit(0.0436) * y * y * y)
    lat = (F.lit(16.9023892) + F.lit(3.238272) * x - F.lit(0.270978) * y * y
           - F.lit(0.002528) * x * x - F.lit(0.0447) * y * y * x
           - F.lit(0.0140) * x * x * x)
    return lat * F.lit(100.0) / F.lit(36.0), lon * F.lit(100.0) / F.lit(36.0)
