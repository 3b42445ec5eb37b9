"""Series at a point and values along a line."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from halocline.functions import geo


def point_series(points: DataFrame, fact: DataFrame, lat: float, lon: float, start: str, end: str, time: str = "time") -> DataFrame:
    """The series of the face nearest to (lat, lon) in an inclusive time window.

    The nearest face is one row, so its id is a scalar subquery: the fact is filtered, not joined.
    """
    near = points.orderBy(geo.planar_degrees(F.lit(lat), F.lit(lon), "lat", "lon"), "face_id").limit(1).select("face_id")
    kind = fact.schema[time].dataType.simpleString()
    return fact.where((F.col("face_id") == near.scalar()) & F.col(time).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def line_points(spark, start: tuple[float, float], end: tuple[float, float], n: int) -> DataFrame:
    """n points from start to end (lat, lon), with their distance from the start in geodesic-free kilometres."""
    f = F.col("id") / (n - 1)
    out = spark.range(n).select(F.col("id").alias("position"), (F.lit(start[0]) + f * (end[0] - start[0])).alias("lat"), (F.lit(start[1]) + f * (end[1] - start[1])).alias("lon"))
    return out.withColumn("distance_km", geo.haversine_km(F.lit(start[0]), F.lit(start[1]), "lat", "lon"))


def elevation_profile(faces: DataFrame, start: tuple[float, float], end: tuple[float, float], n: int, value: str, corners: list[tuple[str, str, str]]) -> DataFrame:
    """Value at n points of a line, linear within the triangle that holds the point; null outside the mesh.

    ``corners`` has (lat, lon, value) columns.  Faces and points meet by an equi-join on grid cells.
    """
    size = max(math.hypot(end[0] - start[0], end[1] - start[1]) / max(n - 1, 1), 1e-6) * 4
    cell = lambda c: F.floor(c / size).cast("long")
    points = line_points(faces.sparkSession, start, end, n)
    lats, lons = [F.col(c[0]) for c in corners], [F.col(c[1]) for c in corners]
    spread = faces.withColumn("cy", F.explode(F.sequence(cell(F.least(*lats)), cell(F.greatest(*lats))))).withColumn("cx", F.explode(F.sequence(cell(F.least(*lons)), cell(F.greatest(*lons)))))
    named = spread.select("cy", "cx", "face_id", *[F.col(c).alias(f"{k}{i}") for i, t in enumerate(corners) for k, c in zip("yxz", t, strict=True)])
    joined = points.withColumn("cy", cell(F.col("lat"))).withColumn("cx", cell(F.col("lon"))).join(named, ["cy", "cx"])
    inside = joined.where(geo.point_in_triangle("lat", "lon", [("y0", "x0"), ("y1", "x1"), ("y2", "x2")]))
    area = (F.col("y1") - F.col("y2")) * (F.col("x0") - F.col("x2")) + (F.col("x2") - F.col("x1")) * (F.col("y0") - F.col("y2"))
    a = ((F.col("y1") - F.col("y2")) * (F.col("lon") - F.col("x2")) + (F.col("x2") - F.col("x1")) * (F.col("lat") - F.col("y2"))) / area
    b = ((F.col("y2") - F.col("y0")) * (F.col("lon") - F.col("x2")) + (F.col("x0") - F.col("x2")) * (F.col("lat") - F.col("y2"))) / area
    valued = inside.withColumn(value, a * F.col("z0") + b * F.col("z1") + (1 - a - b) * F.col("z2"))
    one = valued.groupBy("position").agg(F.min_by(F.struct("face_id", value), "face_id").alias("hit"))  # a point on an edge lies in two faces
    return points.join(one, "position", "left").select("position", "lat", "lon", "distance_km", "hit.face_id", f"hit.{value}")


def vertical_rows(df: DataFrame, keys: list[str], depths: str, values: str) -> DataFrame:
    """Arrays of layer depths and values as (layer, depth, value) rows."""
    return df.select(*keys, F.posexplode(F.arrays_zip(F.col(depths).alias("depth"), F.col(values).alias("value"))).alias("sigma_layer", "r")).select(*keys, "sigma_layer", "r.depth", "r.value")


def nearest_neighbours(df: DataFrame, keys: list[str], rank: str) -> DataFrame:
    """Distance of each ranked spot to the closest other spot of its group; a report's few rows."""
    a, b = df.alias("a"), df.alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    joined = a.join(b, [*same, F.col(f"a.{rank}") != F.col(f"b.{rank}")], "left")
    d = geo.haversine_km("a.lat", "a.lon", "b.lat", "b.lon")
    return joined.groupBy(*[F.col(f"a.{k}").alias(k) for k in keys], F.col(f"a.{rank}").alias(rank)).agg(F.min(d).alias("nearest_km"))


def rank_within(df: DataFrame, keys: list[str], value: str, tie: str, top: int) -> DataFrame:
    """The ``top`` rows of each group by value, numbered; Spark keeps a top-k per task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.desc(value), tie)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
