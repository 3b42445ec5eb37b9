"""Vertical coordinates and depths.  Sigma runs from 0 at the surface to -1 at the floor in ten even layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from halocline.functions.flow import ColumnOrName, as_col

LAYERS = 10
EARTH_RADIUS_M = 6_371_000.0


def sigma_centre(layer: ColumnOrName) -> Column:
    """Layer 0 lies at -0.05, layer 9 at -0.95."""
    return F.lit(-0.05) - F.lit(0.1) * as_col(layer)


def sigma_levels() -> Column:
    """The eleven layer borders, 0 to -1."""
    return F.transform(F.sequence(F.lit(0), F.lit(LAYERS)), lambda i: F.round(i * -0.1, 1))


def centres_of(levels: ColumnOrName) -> Column:
    """Layer centres as means of adjacent levels."""
    x = as_col(levels)
    return F.transform(F.slice(x, F.lit(1), F.size(x) - 1), lambda v, i: (v + F.get(x, i + 1)) / 2)


def sigma_table(spark: SparkSession) -> DataFrame:
    return spark.range(LAYERS).select(F.col("id").cast("int").alias("sigma_layer"), sigma_centre("id").alias("sigma"))


def sea_floor_depth(h: ColumnOrName, zeta: ColumnOrName) -> Column:
    return as_col(h) + as_col(zeta)


def surface_elevation(zeta: ColumnOrName, datum_offset: ColumnOrName) -> Column:
    return as_col(zeta) - as_col(datum_offset)


def sigma_depth(h: ColumnOrName, zeta: ColumnOrName, sigma: ColumnOrName) -> Column:
    """Metres below the surface of a layer's centre."""
    return -(as_col(h) + as_col(zeta)) * as_col(sigma)


def _xyz(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    la, lo = F.radians(lat), F.radians(lon)
    return F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)


def triangle_area(corners: list[tuple[ColumnOrName, ColumnOrName]]) -> Column:
    """m2 of the plane triangle through three (lat, lon) points on the sphere: half the cross product's length."""
    a, b, c = (_xyz(as_col(lat), as_col(lon)) for lat, lon in corners)
    p = [y - x for x, y in zip(a, b, strict=True)]
    q = [y - x for x, y in zip(a, c, strict=True)]
    cross = (p[1] * q[2] - p[2] * q[1], p[2] * q[0] - p[0] * q[2], p[0] * q[1] - p[1] * q[0])
    return F.lit(0.5 * EARTH_RADIUS_M**2) * F.sqrt(cross[0] ** 2 + cross[1] ** 2 + cross[2] ** 2)


def element_volume(area: ColumnOrName, floor_depth: ColumnOrName, elevation: ColumnOrName, add_elevation: bool = False) -> Column:
    """m3 of one layer of a column; ``add_elevation`` counts the elevation on top of a depth that has it already."""
    depth = as_col(floor_depth) + as_col(elevation) if add_elevation else as_col(floor_depth)
    return as_col(area) * depth / LAYERS
