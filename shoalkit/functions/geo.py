"""Longitude/latitude (EPSG:4326) to UTM zone coordinates as column arithmetic.

The transverse Mercator forward series in Krueger's form (third order in the third
flattening n) uses only built-in math functions, so it runs inside whole-stage
codegen with no UDF. Northern hemisphere (false northing 0), as in the reference.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84 ellipsoid and UTM constants.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM12_CENTRAL_MERIDIAN = -111.0
EPSG_UTM12N = 32612


def _series():
    n = WGS84_F / (2 - WGS84_F)
    big_a = WGS84_A / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64)
    c = 2 * math.sqrt(n) / (1 + n)
    alpha = [n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16,
             13 * n ** 2 / 48 - 3 * n ** 3 / 5,
             61 * n ** 3 / 240]
    return big_a, c, alpha


def utm_xy(lon, lat, central_meridian: float = UTM12_CENTRAL_MERIDIAN) -> tuple[Column, Column]:
    """(x, y) Columns in metres for degree columns ``lon``, ``lat``."""
    lon = F.col(lon) if isinstance(lon, str) else lon
    lat = F.col(lat) if isinstance(lat, str) else lat
    big_a, c, alpha = _series()
    phi = F.radians(lat)
    dlam = F.radians(lon - F.lit(central_meridian))
    sphi = F.sin(phi)
    t = F.sinh(F.atanh(sphi) - F.lit(c) * F.atanh(F.lit(c) * sphi))
    xi = F.atan2(t, F.cos(dlam))
    eta = F.atanh(F.sin(dlam) / F.sqrt(F.lit(1.0) + t * t))
    sx, sy = eta, xi
    for j, a in enumerate(alpha, start=1):
        sx = sx + F.lit(a) * F.cos(F.lit(2.0 * j) * xi) * F.sinh(F.lit(2.0 * j) * eta)
        sy = sy + F.lit(a) * F.sin(F.lit(2.0 * j) * xi) * F.cosh(F.lit(2.0 * j) * eta)
    k = UTM_K0 * big_a
    return F.lit(UTM_FALSE_EASTING) + F.lit(k) * sx, F.lit(k) * sy


def utm_sql(lon: str, lat: str, central_meridian: float = UTM12_CENTRAL_MERIDIAN) -> tuple[str, str]:
    """The same series as SQL text (used by the DuckDB oracle and by ``spark.sql`` users)."""
    big_a, c, alpha = _series()
    phi = f"radians({lat})"
    dlam = f"radians({lon} - ({central_meridian!r}))"
    t = f"sinh(atanh(sin({phi})) - {c!r} * atanh({c!r} * sin({phi})))"
    xi = f"atan2({t}, cos({dlam}))"
    eta = f"atanh(sin({dlam}) / sqrt(1.0 + ({t}) * ({t})))"
    sx, sy = eta, xi
    for j, a in enumerate(alpha, start=1):
        sx += f" + {a!r} * cos({2.0 * j!r} * {xi}) * sinh({2.0 * j!r} * {eta})"
        sy += f" + {a!r} * sin({2.0 * j!r} * {xi}) * cosh({2.0 * j!r} * {eta})"
    k = UTM_K0 * big_a
    return f"({UTM_FALSE_EASTING!r} + {k!r} * ({sx}))", f"({k!r} * ({sy}))"
