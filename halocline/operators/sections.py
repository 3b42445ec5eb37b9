"""Vertical sections: values over distance along a line and depth below the surface."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halocline.functions import geo
from halocline.operators import spatial
from halocline.operators.profiles import line_points

Corner = tuple[str, str]


def transect_matrix(faces: DataFrame, start: tuple[float, float], bearing_deg: float, length_km: float, corners: list[Corner], depths: str, values: str, both_ways: bool = True, shore_deviations: float | None = 5.0) -> DataFrame:
    """Cells of a section through all layers of the faces that a line cuts, both ways from ``start``.

    ``depths`` and ``values`` are arrays by layer, from the surface down.  A row per face and layer, with the edges of its
    cell: half way to the neighbouring faces (``from_km``, ``to_km``) and layers (``top_m``, ``bottom_m``); at the ends as
    far out as the neighbour's edge is in, and half a kilometre or metre where there is no neighbour.  On either side the
    section ends at the shore, the first step that is longer than the mean step by ``shore_deviations`` deviations.
    Distances against the bearing are negative.  Faces of one line, not a mesh, are brought in order.
    """
    cut = spatial.transect(faces, start, bearing_deg, length_km, corners, back_km=length_km if both_ways else 0.0)
    cut = cut.withColumn("way_", F.when(F.col("distance_km") < 0, -1).otherwise(1))
    if not both_ways:
        cut = cut.where("way_ = 1")
    if shore_deviations is not None:
        cut = spatial.until_gap(cut.withColumn("away_", F.abs("distance_km")), ["way_"], "away_", shore_deviations).drop("away_")
    w = Window.partitionBy(F.lit(0)).orderBy("distance_km", "face_id")
    before, after, x = F.lag("distance_km").over(w), F.lead("distance_km").over(w), F.col("distance_km")
    half_before, half_after = (x - before) / 2, (after - x) / 2
    placed = cut.select("face_id", x, F.row_number().over(w).alias("position"), (x - F.coalesce(half_before, half_after, F.lit(0.5))).alias("from_km"), (x + F.coalesce(half_after, half_before, F.lit(0.5))).alias("to_km"), F.col(depths).alias("d_"), F.col(values).alias("v_"))
    layers = placed.select("face_id", "position", "distance_km", "from_km", "to_km", "d_", F.posexplode("v_").alias("k", "value"))
    at = lambda i: F.when(i >= 0, F.get("d_", i))
    k, depth = F.col("k"), F.get("d_", F.col("k"))
    up, down = (depth - at(k - 1)) / 2, (at(k + 1) - depth) / 2
    return layers.select(
        "position", "face_id", "distance_km", "from_km", "to_km", k.alias("sigma_layer"), depth.alias("depth_m"),
        (depth - F.coalesce(up, down, F.lit(0.5))).alias("top_m"), (depth + F.coalesce(down, up, F.lit(0.5))).alias("bottom_m"), "value",
    )


def mixed(arrays: list[str], weights: list[Column]) -> Column:
    """The sum of three arrays, element by element, by weight."""
    a, b, c = weights
    first = F.zip_with(arrays[0], arrays[1], lambda x, y: a * x + b * y)
    return F.zip_with(first, F.col(arrays[2]), lambda x, y: x + c * y)


def at_depth(depths: str, values: str, depth: Column) -> Column:
    """Linear between the two layers around a depth; above the first and below the last layer its value."""
    above = F.size(F.filter(depths, lambda d: d <= depth))  # layers at or above the depth
    upper, lower = F.greatest(above - 1, F.lit(0)), F.least(above, F.size(depths) - 1)
    d0, d1, v0, v1 = F.get(depths, upper), F.get(depths, lower), F.get(values, upper), F.get(values, lower)
    return v0 + F.coalesce(F.least(F.greatest(F.try_divide(depth - d0, d1 - d0), F.lit(0.0)), F.lit(1.0)), F.lit(0.0)) * (v1 - v0)


def cross_section(faces: DataFrame, start: tuple[float, float], end: tuple[float, float], n: int, levels: int, corners: list[Corner], floor: list[str], depths: list[str], u: list[str], v: list[str]) -> DataFrame:
    """Flow at ``n`` points of a line and ``levels`` depths from the surface to the deepest floor under it.

    ``corners`` are (lat, lon) columns of a face's corners, and ``floor``, ``depths``, ``u`` and ``v`` a column for each
    corner: the depth of the floor, and arrays by layer from the surface down.  Everything is linear in the triangle that
    holds a point (the face of the least id, on an edge), and then linear between the layers' own depths there, which
    need not be even; above the first and below the last layer their values hold.  ``along`` is the flow towards the end
    of the line, ``across`` to the left of it.  Below the floor and outside the mesh the flow is null.

    Faces and points meet on equal grid cells; only the faces under the line go on to the vertical work.
    """
    spark = faces.sparkSession
    size = max(math.hypot(end[0] - start[0], end[1] - start[1]) / max(n - 1, 1), 1e-6) * 4
    cell = lambda c: F.floor(c / size).cast("long")
    points = line_points(spark, start, end, n)
    lats, lons = [F.col(c[0]) for c in corners], [F.col(c[1]) for c in corners]
    spread = faces.withColumn("cy", F.explode(F.sequence(cell(F.least(*lats)), cell(F.greatest(*lats))))).withColumn("cx", F.explode(F.sequence(cell(F.least(*lons)), cell(F.greatest(*lons)))))
    own = [F.col(c).alias(f"{k}{i}") for k, cs in zip("yxhduv", ([c[0] for c in corners], [c[1] for c in corners], floor, depths, u, v), strict=True) for i, c in enumerate(cs)]
    met = points.withColumn("cy", cell(F.col("lat"))).withColumn("cx", cell(F.col("lon"))).join(spread.select("cy", "cx", "face_id", *own), ["cy", "cx"])
    met = met.where(geo.point_in_triangle("lat", "lon", [("y0", "x0"), ("y1", "x1"), ("y2", "x2")]))
    y, x = ([F.col(f"{k}{i}") for i in range(3)] for k in "yx")
    area = (y[1] - y[2]) * (x[0] - x[2]) + (x[2] - x[1]) * (y[0] - y[2])
    a = ((y[1] - y[2]) * (F.col("lon") - x[2]) + (x[2] - x[1]) * (F.col("lat") - y[2])) / area
    b = ((y[2] - y[0]) * (F.col("lon") - x[2]) + (x[0] - x[2]) * (F.col("lat") - y[2])) / area
    weights = [F.col("a_"), F.col("b_"), 1 - F.col("a_") - F.col("b_")]
    met = met.withColumn("a_", a).withColumn("b_", b)
    column = F.struct("face_id", (weights[0] * F.col("h0") + weights[1] * F.col("h1") + weights[2] * F.col("h2")).alias("floor"), *[mixed([f"{k}0", f"{k}1", f"{k}2"], weights).alias(k) for k in "duv"])
    one = met.groupBy("position").agg(F.min_by(column, "face_id").alias("c"))
    columns = points.join(one, "position", "left").select("position", "lat", "lon", "distance_km", "c.*")
    deepest = F.max("floor").over(Window.partitionBy(F.lit(0)))  # over n rows
    rows = columns.withColumn("deepest", deepest).withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))))
    rows = rows.withColumn("depth_m", F.col("level") * F.col("deepest") / max(levels - 1, 1))
    inside = F.col("depth_m") <= F.col("floor")
    rows = rows.withColumns({f"{k}_": F.when(inside, at_depth("d", k, F.col("depth_m"))) for k in "uv"})
    east = (end[1] - start[1]) * math.cos(math.radians((start[0] + end[0]) / 2))
    far = math.hypot(east, end[0] - start[0]) or 1.0
    ux, uy = east / far, (end[0] - start[0]) / far
    along, across = F.col("u_") * ux + F.col("v_") * uy, F.col("v_") * ux - F.col("u_") * uy
    return rows.select("position", "lat", "lon", "distance_km", "face_id", F.col("floor").alias("floor_m"), "level", "depth_m", F.hypot("u_", "v_").alias("speed"), along.alias("along"), across.alias("across"))
