"""Longitudes, distances, projections and point-in-shape tests, as Columns.

The distance models are named apart: *haversine* is on a sphere of 6371 km, *geodesic* on the WGS84 ellipsoid,
*planar* in degrees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halocline.functions.flow import ColumnOrName, as_col

RADIUS_KM = 6371.0
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563
KM_PER_DEGREE = 111.0


def normalize_longitude(lon: ColumnOrName) -> Column:
    """Into [-180, 180)."""
    return F.pmod(as_col(lon) + 180.0, F.lit(360.0)) - 180.0


def unwrap_longitudes(lons: list[ColumnOrName]) -> list[Column]:
    """Shifted by 360 degrees towards the sign of their mean where they cross the date line."""
    cols = [as_col(x) for x in lons]
    mean = sum(cols[1:], cols[0]) / len(cols)
    wide = F.greatest(*cols) - F.least(*cols) > 180
    return [F.when(wide & (mean >= 0) & (c < 0), c + 360.0).when(wide & (mean < 0) & (c > 0), c - 360.0).otherwise(c) for c in cols]


def crosses_dateline(lons: list[ColumnOrName]) -> Column:
    """Whether any two of the corners lie more than 180 degrees apart."""
    cols = [as_col(x) for x in lons]
    return F.greatest(*cols) - F.least(*cols) > 180


def line_crosses_dateline(points: ColumnOrName) -> Column:
    """Of an array of structs with ``lon``: whether consecutive points lie more than 180 degrees apart."""
    x = as_col(points)
    return F.exists(F.sequence(F.lit(1), F.greatest(F.size(x) - 1, F.lit(1))), lambda i: F.coalesce(F.abs(F.get(x, i)["lon"] - F.get(x, i - 1)["lon"]) > 180, F.lit(False)))


def one_hemisphere(lons: ColumnOrName) -> Column:
    """An array of longitudes on the side that most of them are on, west in a tie; they go beyond 180 degrees."""
    x = as_col(lons)
    west = F.size(F.filter(x, lambda v: v < 0)) >= F.size(F.filter(x, lambda v: v > 0))
    return F.when(west, F.transform(x, lambda v: F.when(v > 0, v - 360.0).otherwise(v))).otherwise(F.transform(x, lambda v: F.when(v < 0, v + 360.0).otherwise(v)))


#: A winter's day, so that offsets are those of standard time in the north.
OFFSET_DAY = "2023-01-15"


def utc_offset_hours(zone: ColumnOrName, day: str = OFFSET_DAY) -> Column:
    """A time zone's offset at noon (UTC) of a day, in whole hours towards zero."""
    noon = F.lit(f"{day} 12:00:00").cast("timestamp_ntz")
    return (F.timestamp_diff("MINUTE", noon, F.convert_timezone(F.lit("UTC"), as_col(zone), noon)) / 60).cast("int")


def haversine_km(lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName) -> Column:
    a1, o1, a2, o2 = (F.radians(as_col(c)) for c in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), 2)
    return F.lit(2 * RADIUS_KM) * F.asin(F.least(F.sqrt(h), F.lit(1.0)))


def planar_degrees(lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName, wrap: bool = False) -> Column:
    dlon = as_col(lon2) - as_col(lon1)
    if wrap:
        dlon = normalize_longitude(dlon)
    return F.sqrt(F.pow(as_col(lat2) - as_col(lat1), 2) + F.pow(dlon, 2))


def point_in_triangle(lat: ColumnOrName, lon: ColumnOrName, corners: list[tuple[ColumnOrName, ColumnOrName]], eps: float = 1e-10) -> Column:
    """By barycentric coordinates; false for a triangle without area.  Longitudes are unwrapped at the date line."""
    x, x1, x2, x3 = unwrap_longitudes([lon, *(c[1] for c in corners)])
    y, (y1, y2, y3) = as_col(lat), [as_col(c[0]) for c in corners]
    area = (y2 - y3) * (x1 - x3) + (x3 - x2) * (y1 - y3)
    a = F.try_divide((y2 - y3) * (x - x3) + (x3 - x2) * (y - y3), area)
    b = F.try_divide((y3 - y1) * (x - x3) + (x1 - x3) * (y - y3), area)
    inside = (a >= -eps) & (b >= -eps) & (1 - a - b >= -eps)
    return F.when(F.abs(area) < eps, F.lit(False)).otherwise(F.coalesce(inside, F.lit(False)))


def point_in_ring(lat: ColumnOrName, lon: ColumnOrName, ring: ColumnOrName) -> Column:
    """Even-odd rule over a ring given as an array of structs (lon, lat), closed or not."""
    y, x, r = as_col(lat), as_col(lon), as_col(ring)
    n = F.size(r)

    def crosses(i: Column) -> Column:
        p, q = F.get(r, i), F.get(r, F.pmod(i + 1, n))
        return ((p["lat"] > y) != (q["lat"] > y)) & (x < F.try_divide((q["lon"] - p["lon"]) * (y - p["lat"]), q["lat"] - p["lat"]) + p["lon"])

    hits = F.size(F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.coalesce(crosses(i), F.lit(False))))
    return F.when(n >= 3, hits % 2 == 1).otherwise(F.lit(False))


def web_mercator(lat: ColumnOrName, lon: ColumnOrName) -> tuple[Column, Column]:
    """(x, y) metres of EPSG:3857."""
    return F.radians(as_col(lon)) * WGS84_A, F.log(F.tan(F.lit(math.pi / 4) + F.radians(as_col(lat)) / 2)) * WGS84_A


def web_mercator_inverse(x: ColumnOrName, y: ColumnOrName) -> tuple[Column, Column]:
    """(lat, lon) of EPSG:3857 metres."""
    return F.degrees(2 * F.atan(F.exp(as_col(y) / WGS84_A)) - math.pi / 2), F.degrees(as_col(x) / WGS84_A)


def utm_zone(lat: ColumnOrName, lon: ColumnOrName) -> Column:
    """Zone number, with the exceptions of south-west Norway and Svalbard."""
    la, lo = as_col(lat), normalize_longitude(lon)
    plain = F.least(F.floor((lo + 180) / 6) + 1, F.lit(60)).cast("int")
    svalbard = (la >= 72) & (la < 84)
    return (
        F.when((la >= 56) & (la < 64) & (lo >= 3) & (lo < 12), 32)
        .when(svalbard & (lo >= 0) & (lo < 9), 31)
        .when(svalbard & (lo >= 9) & (lo < 21), 33)
        .when(svalbard & (lo >= 21) & (lo < 33), 35)
        .when(svalbard & (lo >= 33) & (lo < 42), 37)
        .otherwise(plain)
    )


def utm_inverse(x: ColumnOrName, y: ColumnOrName, zone: int) -> tuple[Column, Column]:
    """(lat, lon) of northern UTM coordinates, by the Krueger series to third order in n (below 1 mm)."""
    n = WGS84_F / (2 - WGS84_F)
    big_a = WGS84_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    xi, eta = as_col(y) / (0.9996 * big_a), (as_col(x) - 500_000.0) / (0.9996 * big_a)
    xi_, eta_ = xi, eta
    for j, b in enumerate(beta, 1):
        xi_ = xi_ - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta_ = eta_ - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi_) / F.cosh(eta_))
    lat = chi
    for j, d in enumerate(delta, 1):
        lat = lat + d * F.sin(2 * j * chi)
    lon = F.atan2(F.sinh(eta_), F.cos(xi_))
    return F.degrees(lat), F.degrees(lon) + (6 * zone - 183)


def geodesic_metres(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """Vincenty's inverse on WGS84; for points that it does not settle (nearly opposite ones) a sphere's distance."""
    a, f = WGS84_A, WGS84_F
    b = a * (1 - f)
    p1, p2 = np.radians(lat1), np.radians(lat2)
    u1, u2 = np.arctan((1 - f) * np.tan(p1)), np.arctan((1 - f) * np.tan(p2))
    dl = (np.radians(lon2 - lon1) + np.pi) % (2 * np.pi) - np.pi
    lam = dl.copy()
    with np.errstate(all="ignore"):
        for _ in range(60):
            s, c = np.sin(lam), np.cos(lam)
            sin_s = np.hypot(np.cos(u2) * s, np.cos(u1) * np.sin(u2) - np.sin(u1) * np.cos(u2) * c)
            cos_s = np.sin(u1) * np.sin(u2) + np.cos(u1) * np.cos(u2) * c
            sigma = np.arctan2(sin_s, cos_s)
            sin_a = np.where(sin_s > 0, np.cos(u1) * np.cos(u2) * s / np.where(sin_s > 0, sin_s, 1), 0)
            cos2a = 1 - sin_a**2
            cos_m = np.where(cos2a > 1e-15, cos_s - 2 * np.sin(u1) * np.sin(u2) / np.where(cos2a > 1e-15, cos2a, 1), 0)
            k = f / 16 * cos2a * (4 + f * (4 - 3 * cos2a))
            after = dl + (1 - k) * f * sin_a * (sigma + k * sin_s * (cos_m + k * cos_s * (2 * cos_m**2 - 1)))
            settled = np.abs(after - lam) < 1e-12
            lam = np.where(settled, lam, after)
            if settled.all():
                break
        w = cos2a * (a**2 - b**2) / b**2
        big = 1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w)))
        small = w / 1024 * (256 + w * (-128 + w * (74 - 47 * w)))
        ds = small * sin_s * (cos_m + small / 4 * (cos_s * (2 * cos_m**2 - 1) - small / 6 * cos_m * (4 * sin_s**2 - 3) * (4 * cos_m**2 - 3)))
        out = b * big * (sigma - ds)
        sphere = 2 * 6371008.8 * np.arcsin(np.minimum(1, np.sqrt(np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(dl / 2) ** 2)))
    return np.where(settled, out, sphere)


@F.pandas_udf(T.DoubleType())
def geodesic_m(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """WGS84 metres between (lat1, lon1) and (lat2, lon2), vectorised over Arrow batches."""
    for lat1, lon1, lat2, lon2 in parts:
        yield pd.Series(geodesic_metres(*(x.to_numpy(np.float64) for x in (lat1, lon1, lat2, lon2))))


def grid_resolution(corners: list[tuple[ColumnOrName, ColumnOrName]]) -> Column:
    """Mean geodesic length of a triangle's edges."""
    pairs = [(corners[i], corners[(i + 1) % 3]) for i in range(3)]
    edges = [geodesic_m(as_col(p[0]), as_col(p[1]), as_col(q[0]), as_col(q[1])) for p, q in pairs]
    return (edges[0] + edges[1] + edges[2]) / 3


def along_and_across(lat: ColumnOrName, lon: ColumnOrName, start: tuple[float, float], end: tuple[float, float]) -> tuple[Column, Column, float]:
    """Planar degrees along and across the line from start to end (lat, lon), and the line's length."""
    dy, dx = end[0] - start[0], end[1] - start[1]
    length = math.hypot(dx, dy)
    uy, ux = (dy / length, dx / length) if length else (0.0, 0.0)
    py, px = as_col(lat) - start[0], as_col(lon) - start[1]
    return px * ux + py * uy, F.abs(px * uy - py * ux), length


def buffered(lo: ColumnOrName, hi: ColumnOrName, percent: float) -> tuple[Column, Column]:
    pad = (as_col(hi) - as_col(lo)) * (percent / 100)
    return as_col(lo) - pad, as_col(hi) + pad


def zoom_level(lon_span: ColumnOrName) -> Column:
    """Map zoom of a longitude span; 10 where it is unknown."""
    out = F.when(as_col(lon_span).isNull(), 10)
    for zoom, span in enumerate((3, 1, 0.5, 0.2, 0.1, 0.05, 0.02), 7):
        out = out.when(as_col(lon_span) > span, zoom)
    return out.otherwise(14)
