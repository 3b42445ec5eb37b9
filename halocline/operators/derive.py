"""Derived quantities of raw velocity and elevation facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halocline.functions import depth, flow

DEPTH_VARIABLES = ("u", "v", "to_direction", "speed", "power_density")


def add_flow(df: DataFrame, u: str = "u", v: str = "v", prefix: str = "") -> DataFrame:
    """speed, to_direction and power_density beside u and v; NaN counts as null."""
    cu, cv = flow.null_if_nan(F.col(u).cast("double")), flow.null_if_nan(F.col(v).cast("double"))
    out = df.withColumn(f"{prefix}speed", flow.speed(cu, cv)).withColumn(f"{prefix}to_direction", flow.to_direction(cu, cv))
    return out.withColumn(f"{prefix}power_density", flow.power_density(f"{prefix}speed"))


def gather_nodes(face_node: DataFrame, node_values: DataFrame, value: str, keys: list[str], at: list[str] | None = None) -> DataFrame:
    """Mean over a face's three nodes of a node value, per face (and time): ``<value>_center``.

    Two keyed joins at most; the mean is partial before the shuffle.  A face without all three values gets none.
    """
    at = at or []
    joined = face_node.join(node_values, [*[k for k in keys if k != "face_id"], "node_id"])
    mean = F.when(F.count(value) == 3, F.avg(value))
    return joined.groupBy(*keys, *at).agg(mean.alias(f"{value}_center"))


def corner_columns(face_node: DataFrame, node: DataFrame, keys: list[str]) -> DataFrame:
    """element_corner_{1..3}_{lat,lon} per face, by one keyed join and a conditional aggregate."""
    joined = face_node.join(node, [*[k for k in keys if k != "face_id"], "node_id"])
    cols = [F.max(F.when(F.col("corner") == c, F.col(src))).alias(f"element_corner_{c}_{axis}") for c in (1, 2, 3) for axis, src in (("lat", "lat_node"), ("lon", "lon_node"))]
    return joined.groupBy(*keys).agg(*cols)


def add_depths(fact: DataFrame, face: DataFrame, keys: list[str]) -> DataFrame:
    """zeta_center facts with floor depth, surface elevation and an array of ten layer depths."""
    out = fact.join(face.select(*keys, "h_center", "mean_navd88_offset"), keys, "left")
    out = out.withColumn("sea_floor_depth", depth.sea_floor_depth("h_center", "zeta_center")).withColumn("surface_elevation", depth.surface_elevation("zeta_center", "mean_navd88_offset"))
    layers = F.transform(F.sequence(F.lit(0), F.lit(depth.LAYERS - 1)), lambda i: depth.sigma_depth("h_center", "zeta_center", depth.sigma_centre(i)))
    return out.withColumn("sigma_depths", layers).drop("h_center", "mean_navd88_offset")


def datum_offset(zeta: DataFrame, keys: list[str]) -> DataFrame:
    """Mean elevation of each face over all times."""
    return zeta.groupBy(*keys).agg(F.avg("zeta_center").alias("mean_navd88_offset"))


def depth_statistics(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean, median, max and 95th percentile over the layers of each key; nulls are skipped."""
    v = F.col(value)
    return df.groupBy(*keys).agg(F.avg(v).alias(f"{value}_mean"), F.percentile(v, 0.5).alias(f"{value}_median"), F.max(v).alias(f"{value}_max"), F.percentile(v, 0.95).alias(f"{value}_p95"))


def layer_array_statistics(layers: Column) -> dict[str, Column]:
    """Mean and max of an array of layers, without exploding it."""
    known = F.filter(layers, lambda x: x.isNotNull() & ~F.isnan(x))
    total = F.aggregate(known, F.lit(0.0), lambda a, x: a + x.cast("double"))
    return {"mean": F.try_divide(total, F.size(known).cast("double")), "max": F.array_max(known).cast("double")}


def join_static(fact: DataFrame, face: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Static face columns onto a fact; Spark broadcasts the face table only below its size threshold."""
    return fact.join(face.select(*keys, *columns), keys, "left")
