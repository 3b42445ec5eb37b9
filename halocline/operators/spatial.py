"""Grid manifest, point, area and line searches, polygons, meshes, shores and hotspots."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halocline.functions import geo, names
from halocline.operators.coast import jurisdiction as jurisdiction

# ---------------------------------------------------------------- manifest


def grid_points(points: DataFrame, resolution: float = 0.01) -> DataFrame:
    """Points (location, face_id, lat, lon) with their cell: key columns, id, and bounds of the cell."""
    sign = lambda c: F.when(F.col(c) < 0, -1.0).otherwise(1.0)
    out = points
    for axis in ("lat", "lon"):
        out = out.withColumn(f"{axis}_deg", names.degree_key(axis)).withColumn(f"{axis}_dec", names.decimal_key(axis).cast("int"))
        edge = F.col(f"{axis}_deg") + sign(axis) * F.col(f"{axis}_dec") * resolution
        out = out.withColumn(f"{axis}_min", F.round(edge, 6)).withColumn(f"{axis}_max", F.round(edge + resolution, 6))
    return out.withColumn("grid_id", names.grid_id("lat", "lon"))


def grid_index(cells: DataFrame) -> DataFrame:
    """One row per cell: bounds, centroid and number of points."""
    bounds = [F.min(c).alias(c) for c in ("lat_min", "lon_min")] + [F.max(c).alias(c) for c in ("lat_max", "lon_max")]
    out = cells.groupBy("grid_id").agg(*bounds, F.count("*").alias("n"))
    return out.withColumn("centroid_lat", (F.col("lat_min") + F.col("lat_max")) / 2).withColumn("centroid_lon", (F.col("lon_min") + F.col("lon_max")) / 2)


def grid_point_lists(cells: DataFrame) -> DataFrame:
    """Nested point lists per cell and location, in order of face; a cell holds 0.01 degrees' faces."""
    point = F.struct(names.face_label("face_id").alias("face_id"), F.format_string("%.7f", "lat").alias("lat"), F.format_string("%.7f", "lon").alias("lon"))
    return cells.groupBy("grid_id", "location").agg(F.array_sort(F.collect_list(point)).alias("points"))


def grid_boxes(index: DataFrame, size: float, half_cell: float = 0.005) -> DataFrame:
    """Cells gathered in boxes of ``size`` degrees: bounds around the centroids, and counts."""
    box = lambda c: F.floor(F.col(c) / size) * size
    out = index.groupBy(box("centroid_lat").alias("box_lat"), box("centroid_lon").alias("box_lon"))
    return out.agg((F.min("centroid_lat") - half_cell).alias("lat_min"), (F.max("centroid_lat") + half_cell).alias("lat_max"), (F.min("centroid_lon") - half_cell).alias("lon_min"), (F.max("centroid_lon") + half_cell).alias("lon_max"), F.count("*").alias("n_cells"), F.sum("n").alias("n_points"))


# ---------------------------------------------------------------- searches


def nearest(points: DataFrame, lat: float, lon: float, resolution: float = 0.01, max_degrees: float | None = None, anywhere: bool = False) -> DataFrame:
    """The point nearest to (lat, lon) by haversine, out of those within three cells; no row when there is none.

    The box filter reaches the scan, so only row groups around the point are read.
    """
    reach = 3 * resolution
    near = points if anywhere else points.where(F.col("lat").between(lat - reach, lat + reach) & F.col("lon").between(lon - reach, lon + reach))
    out = near.withColumn("distance_km", geo.haversine_km(F.lit(lat), F.lit(lon), "lat", "lon"))
    if max_degrees is not None:
        out = out.where(F.col("distance_km") <= max_degrees * geo.KM_PER_DEGREE)
    return out.orderBy("distance_km", "face_id").limit(1)


def k_nearest(points: DataFrame, lat: float, lon: float, k: int, wrap: bool = False) -> DataFrame:
    """The k points nearest by planar degrees: a top-k per task, then one of the k * tasks left."""
    return points.withColumn("distance_deg", geo.planar_degrees(F.lit(lat), F.lit(lon), "lat", "lon", wrap)).orderBy("distance_deg", "face_id").limit(k)


def within_area(index: DataFrame, lat_min: float, lat_max: float, lon_min: float, lon_max: float, buffer_degrees: float = 0.0, edges_only: bool = False) -> DataFrame:
    """Cells whose centroid lies in the rectangle or within the buffer around it; or near its edges only."""
    y, x = F.col("centroid_lat"), F.col("centroid_lon")
    inside = y.between(lat_min, lat_max) & x.between(lon_min, lon_max)
    if not buffer_degrees:
        return index.where(inside)
    dy = F.greatest(F.lit(lat_min) - y, y - F.lit(lat_max), F.lit(0.0))
    dx = F.greatest(F.lit(lon_min) - x, x - F.lit(lon_max), F.lit(0.0))
    outside_near = F.sqrt(dy * dy + dx * dx) <= buffer_degrees
    if not edges_only:
        return index.where(outside_near)
    to_edge = F.least(y - lat_min, F.lit(lat_max) - y, x - lon_min, F.lit(lon_max) - x)
    return index.where(F.when(inside, to_edge <= buffer_degrees).otherwise(outside_near))


def along_line(index: DataFrame, start: tuple[float, float], end: tuple[float, float], max_degrees: float, max_points: int | None = None) -> DataFrame:
    """Cells within ``max_degrees`` of a line, in order along it; at most ``max_points``, those closest to it."""
    along, across, length = geo.along_and_across("centroid_lat", "centroid_lon", start, end)
    out = index.withColumn("along", along).withColumn("across", across)
    out = out.where((F.col("across") <= max_degrees) & F.col("along").between(-max_degrees, length + max_degrees))
    if max_points is not None:
        out = out.orderBy(F.round("across", 9), "grid_id").limit(max_points)  # cells equally far but for rounding go by id
    return out.orderBy("along", "grid_id")


# ---------------------------------------------------------------- polygons and shores


def convex_hull(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The closed hull of points, anticlockwise."""
    left = sorted(set(points))
    if len(left) < 3:
        return [*left, *left[:1]]

    def chain(some: list[tuple[float, float]]) -> list[tuple[float, float]]:
        out: list[tuple[float, float]] = []
        for p in some:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out

    lower, upper = chain(left), chain(left[::-1])
    return [*lower, *upper[1:]]


def line_outline(points: str, margin: float = 2.0) -> Column:
    """A boundary line, an array of (lon, lat), as a closed ring: its hull, or a box around the globe with
    ``margin`` degrees of latitude on either side if it crosses the date line."""
    ring = T.ArrayType(T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())]))

    @F.pandas_udf(ring)
    def hull(lines: pd.Series) -> pd.Series:
        return pd.Series([[{"lon": x, "lat": y} for x, y in convex_hull([(p["lon"], p["lat"]) for p in line])] for line in lines])

    lats = F.transform(points, lambda p: p["lat"])
    low, high = F.array_min(lats) - margin, F.array_max(lats) + margin
    corner = lambda x, y: F.struct(F.lit(x).alias("lon"), y.alias("lat"))
    box = F.array(corner(-180.0, low), corner(180.0, low), corner(180.0, high), corner(-180.0, high), corner(-180.0, low))
    return F.when(geo.line_crosses_dateline(points), box).otherwise(hull(F.col(points)))


def densify(lines: DataFrame, line: str, step_km: float) -> DataFrame:
    """Points (lat, lon) on coast lines, arrays of (lon, lat): all vertices, and between them one every ``step_km`` at most.

    Longitudes take the shorter way, so that a line may cross the date line.
    """
    ends = lines.select(F.posexplode(F.arrays_zip(F.slice(line, 1, F.greatest(F.size(line) - 1, F.lit(1))).alias("a"), F.slice(line, 2, F.greatest(F.size(line) - 1, F.lit(1))).alias("b"))).alias("at", "s"))
    ends = ends.select(F.col("s.a.lat").alias("y"), F.col("s.a.lon").alias("x"), F.coalesce("s.b.lat", "s.a.lat").alias("y2"), F.coalesce("s.b.lon", "s.a.lon").alias("x2"))
    parts = F.greatest(F.ceil(geo.haversine_km("y", "x", "y2", "x2") / step_km), F.lit(1))
    ends = ends.withColumn("parts", parts).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts"))))
    share = F.col("i") / F.col("parts")
    across = geo.normalize_longitude(F.col("x2") - F.col("x"))
    lat = F.when(F.col("i") == F.col("parts"), F.col("y2")).otherwise(F.col("y") + share * (F.col("y2") - F.col("y")))
    lon = F.when(F.col("i") == F.col("parts"), F.col("x2")).when(F.col("i") == 0, F.col("x")).otherwise(geo.normalize_longitude(F.col("x") + share * across))
    return ends.select(lat.alias("lat"), lon.alias("lon")).distinct()


def distance_to_shore(points: DataFrame, shore: DataFrame, keys: list[str], radii_km: tuple[float, ...] = (4.0, 16.0, 64.0, 256.0, 1000.0), snap_km: float = 1.852) -> DataFrame:
    """Nearest shore point within the first radius that has one; distances under one nautical mile are 0.

    Each radius is an equi-join on cells at least as high as the radius, with as many columns around the globe as fit: a
    point meets the shore points of three rows of cells and of the columns that its circle reaches, over the date line,
    and of all columns where the circle holds a pole.  Only points without a hit go on to the next radius, so that few
    pairs are formed where the coast is near.  A point beyond all radii has nulls.
    """
    shore_at = F.struct("km", "shore_lat", "shore_lon")
    state = points.select(*keys, F.col("lat"), F.col("lon"), F.lit(None).cast("struct<km: double, shore_lat: double, shore_lon: double>").alias("hit"))
    for radius in radii_km:
        columns = max(1, int(360 * 111 // radius))
        size = 360.0 / columns  # degrees; a degree of latitude is over 111 km
        row = lambda lat: F.floor(F.col(lat) / size).cast("int")
        column = lambda lon: F.pmod(F.floor((F.col(lon) + 180) / size).cast("int"), F.lit(columns))
        cells = shore.select(F.col("lat").alias("shore_lat"), F.col("lon").alias("shore_lon")).withColumn("cell_y", row("shore_lat")).withColumn("cell_x", column("shore_lon"))
        # the circle's reach in longitude; none where it holds a pole
        swing = F.try_divide(F.lit(math.sin(radius / geo.RADIUS_KM)), F.cos(F.radians("lat")))
        reach = F.when(F.abs(swing) < 1, F.ceil(F.degrees(F.asin(swing)) / size).cast("int"))
        whole = F.coalesce(2 * reach + 1 >= columns, F.lit(True))
        around = F.when(whole, F.sequence(F.lit(0), F.lit(columns - 1))).otherwise(F.transform(F.sequence(column("lon") - F.coalesce(reach, F.lit(0)), column("lon") + F.coalesce(reach, F.lit(0))), lambda x: F.pmod(x, F.lit(columns))))
        found = F.col("hit").isNotNull()
        # points with a hit take no part: one row each, in rows of cells that no shore has
        idle = F.array(F.lit(-1_000_000) - F.pmod(F.xxhash64(*keys), F.lit(1000)).cast("int"))
        asked = state.withColumn("cell_y", F.explode(F.when(found, idle).otherwise(F.sequence(row("lat") - 1, row("lat") + 1))))
        asked = asked.withColumn("cell_x", F.explode(F.when(found, F.array(F.lit(0))).otherwise(around)))
        pairs = asked.join(cells, ["cell_y", "cell_x"], "left").withColumn("km", geo.haversine_km("lat", "lon", "shore_lat", "shore_lon"))
        best = F.min(F.when(F.col("km") <= radius, shore_at))
        state = pairs.groupBy(*keys, "lat", "lon").agg(F.coalesce(F.first("hit"), best).alias("hit"))
    near = F.col("hit.km") < snap_km
    found = state.select(
        *keys,
        F.when(near, 0.0).otherwise(F.col("hit.km") / 1.852).alias("distance_to_shore_nm"),
        F.when(near, F.col("lat")).otherwise(F.col("hit.shore_lat")).alias("closest_shore_lat"),
        F.when(near, F.col("lon")).otherwise(F.col("hit.shore_lon")).alias("closest_shore_lon"),
    )
    return points.join(found, keys, "left")


# ---------------------------------------------------------------- mesh


def boundary_edges(face_node: DataFrame, keys: list[str]) -> DataFrame:
    """Undirected edges that only one face has."""
    nodes = face_node.groupBy(*keys, "face_id").agg(F.array_sort(F.collect_list(F.struct("corner", "node_id"))).alias("c"))  # three corners
    edge = lambda i, j: F.struct(F.least(F.col("c")[i]["node_id"], F.col("c")[j]["node_id"]).alias("a"), F.greatest(F.col("c")[i]["node_id"], F.col("c")[j]["node_id"]).alias("b"))
    edges = nodes.select(*keys, F.explode(F.array(edge(0, 1), edge(1, 2), edge(0, 2))).alias("e")).select(*keys, "e.a", "e.b")
    return edges.groupBy(*keys, "a", "b").agg(F.count("*").alias("n")).where("n = 1").drop("n")


def order_ring(pdf: pd.DataFrame) -> list[list[int]]:
    """Closed walks over boundary edges (a, b), the longest first."""
    after: dict[int, list[int]] = {}
    for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist(), strict=True):
        after.setdefault(a, []).append(b)
        after.setdefault(b, []).append(a)
    rings = []
    while after:
        start = here = min(after)
        ring = [start]
        while True:
            onward = sorted(after.get(here, []))
            if not onward:
                break
            to = onward[0]
            after[here].remove(to)
            after[to].remove(here)
            for n in (here, to):
                if not after[n]:
                    del after[n]
            ring.append(to)
            here = to
            if here == start:
                break
        rings.append(ring)
    return sorted(rings, key=len, reverse=True)


def mesh_boundary(face_node: DataFrame, node: DataFrame, keys: list[str]) -> DataFrame:
    """Outer ring of each mesh as WKT; only boundary edges, a small part of a mesh's edges, are gathered per mesh.

    Longitudes west of the date line go on beyond 180 degrees where that makes the ring narrower.
    """
    edges = boundary_edges(face_node, keys)
    at = node.select(*keys, "node_id", "lat_node", "lon_node")
    for end in ("a", "b"):
        edges = edges.join(at.select(*keys, F.col("node_id").alias(end), F.col("lat_node").alias(f"lat_{end}"), F.col("lon_node").alias(f"lon_{end}")), [*keys, end])
    schema = edges.select(*keys).schema.simpleString()[len("struct<") : -1].replace(":", " ") + ", wkt string, n_nodes long"

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        where = {n: (x, y) for e in ("a", "b") for n, x, y in zip(pdf[e], pdf[f"lon_{e}"], pdf[f"lat_{e}"], strict=True)}
        ring = order_ring(pdf)[0]
        lons = np.array([where[n][0] for n in ring])
        if np.ptp(np.where(lons < 0, lons + 360, lons)) < np.ptp(lons):
            where = {n: (x + 360 if x < 0 else x, y) for n, (x, y) in where.items()}
        wkt = "POLYGON ((" + ", ".join(f"{where[n][0]:.6f} {where[n][1]:.6f}" for n in ring) + "))"
        return pd.DataFrame([{**dict(zip(keys, key, strict=True)), "wkt": wkt, "n_nodes": len(ring) - 1}])

    return edges.groupBy(*keys).applyInPandas(one, schema)


def triangle_ring(corners: list[tuple[str, str]]) -> Column:
    """Closed ring of (lon, lat) structs."""
    point = [F.struct(F.col(lon).cast("double").alias("lon"), F.col(lat).cast("double").alias("lat")) for lat, lon in corners]
    return F.array(*point, point[0])


def split_at_dateline(ring: list[tuple[float, float]], gap: float = 0.001) -> list[list[tuple[float, float]]]:
    """A triangle (lon, lat) that crosses the date line as parts on either side, ``gap`` degrees away from it."""
    lons = [p[0] for p in ring]
    if max(lons) - min(lons) <= 180:
        return [ring]
    east = [(x if x >= 0 else x + 360, y) for x, y in ring]
    parts = []
    for keep, edge, shift in ((lambda x: x <= 180, 180 - gap, 0), (lambda x: x >= 180, 180 + gap, -360)):
        points = []
        for (x1, y1), (x2, y2) in zip(east, east[1:] + east[:1], strict=True):
            if keep(x1):
                points.append((x1, y1))
            if keep(x1) != keep(x2):
                points.append((edge, y1 + (y2 - y1) * (180 - x1) / (x2 - x1)))
        if len(points) >= 3:
            cx, cy = np.mean(points, axis=0)
            parts.append([(x + shift, y) for x, y in sorted(points, key=lambda p: math.atan2(p[1] - cy, p[0] - cx))])
    return parts


def split_dateline(df: DataFrame, corners: list[tuple[str, str]]) -> DataFrame:
    """A row per part of each triangle, with split_part (from 1) and split_total; most have one part."""
    point = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])

    @F.pandas_udf(T.ArrayType(T.ArrayType(point)))
    def split(rings: pd.Series) -> pd.Series:
        return pd.Series([[[{"lon": x, "lat": y} for x, y in part] for part in split_at_dateline([(p["lon"], p["lat"]) for p in ring])] for ring in rings])

    whole = triangle_ring(corners)
    parts = F.when(geo.crosses_dateline([lon for _, lon in corners]), split(F.slice(whole, 1, 3))).otherwise(F.array(F.slice(whole, 1, 3)))
    out = df.withColumn("parts_", parts).select(*df.columns, F.size("parts_").alias("split_total"), F.posexplode("parts_").alias("split_part", "ring"))
    return out.withColumn("split_part", F.col("split_part") + 1)


# ---------------------------------------------------------------- transects and hotspots


def transect(faces: DataFrame, start: tuple[float, float], bearing_deg: float, length_km: float, corners: list[tuple[str, str]], back_km: float = 0.0) -> DataFrame:
    """Faces that a line from ``start`` on a bearing cuts, in order of their distance along it (km, planar).

    A face is cut when its corners lie on both sides of the line and it reaches into the line's span, which goes on for
    ``back_km`` in the opposite direction, where distances are negative.
    """
    km_lat, km_lon = geo.KM_PER_DEGREE, geo.KM_PER_DEGREE * math.cos(math.radians(start[0]))
    uy, ux = math.cos(math.radians(bearing_deg)), math.sin(math.radians(bearing_deg))
    rel = [((F.col(lat) - start[0]) * km_lat, (F.col(lon) - start[1]) * km_lon) for lat, lon in corners]
    side = [x * uy - y * ux for y, x in rel]
    along = [y * uy + x * ux for y, x in rel]
    cut = (F.least(*side) <= 0) & (F.greatest(*side) >= 0) & (F.greatest(*along) >= -back_km) & (F.least(*along) <= length_km)
    return faces.where(cut).withColumn("distance_km", (along[0] + along[1] + along[2]) / 3).orderBy("distance_km", "face_id")


def until_gap(df: DataFrame, keys: list[str], distance: str, deviations: float = 5.0) -> DataFrame:
    """Rows of each series before the first step longer than the mean step plus ``deviations`` deviations."""
    w = Window.partitionBy(*keys)
    stepped = df.withColumn("step_", F.col(distance) - F.lag(distance).over(w.orderBy(distance)))
    limit = F.avg("step_").over(w) + deviations * F.stddev_pop("step_").over(w)
    first = F.min(F.when(F.col("step_") > F.col("limit_"), F.col(distance))).over(w)
    return stepped.withColumn("limit_", limit).withColumn("cut_", first).where(F.col("cut_").isNull() | (F.col(distance) < F.col("cut_"))).drop("step_", "limit_", "cut_")


def path_distance(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Cumulative haversine kilometres along each series' points."""
    w = Window.partitionBy(*keys).orderBy(order)
    step = geo.haversine_km(F.lag("lat").over(w), F.lag("lon").over(w), "lat", "lon")
    return df.withColumn("step_", F.coalesce(step, F.lit(0.0))).withColumn("distance_km", F.sum("step_").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("step_")


def hotspots(faces: DataFrame, value: str, top_n: int, spacing_m: float, relax: float = 0.8, least: float = 0.3, pool: int = 5_000) -> DataFrame:
    """The ``top_n`` highest faces that keep ``spacing_m`` from each other, greedily; the spacing is relaxed by
    ``relax`` down to ``least`` of it while too few are found.

    Candidates come in pools from the top; the next pool leaves out what lies too near to faces chosen already.
    So the choice is that over all faces, and the driver holds one pool.
    """
    spark = faces.sparkSession
    ranked = faces.where(F.col(value).isNotNull()).select("face_id", "lat", "lon", F.col(value).cast("double").alias("v_"))
    spacing = spacing_m
    while True:
        chosen = choose_spaced(ranked, top_n, spacing, pool)
        if len(chosen) == top_n or spacing * relax < spacing_m * least:
            break
        spacing *= relax
    out = [(k + 1, r["face_id"], r["lat"], r["lon"], r["v_"], spacing) for k, r in enumerate(chosen)]
    return spark.createDataFrame(out, f"rank int, face_id long, lat double, lon double, {value} double, spacing_m double")


def choose_spaced(ranked: DataFrame, top_n: int, spacing_m: float, pool: int) -> list:
    chosen: list = []
    left = ranked
    while len(chosen) < top_n:
        rows = left.orderBy(F.desc("v_"), "face_id").limit(pool).collect()
        for r in rows:
            if len(chosen) < top_n and all(planar_metres(r["lat"], r["lon"], c["lat"], c["lon"]) >= spacing_m for c in chosen):
                chosen.append(r)
        if len(rows) < pool:
            break
        last = rows[-1]
        left = ranked.where((F.col("v_") < last["v_"]) | ((F.col("v_") == last["v_"]) & (F.col("face_id") > last["face_id"])))
        for c in chosen:
            dy, dx = (F.col("lat") - c["lat"]) * 111_000.0, (F.col("lon") - c["lon"]) * 111_000.0 * F.cos(F.radians("lat"))
            left = left.where(F.sqrt(dy * dy + dx * dx) >= spacing_m)
    return chosen


def neighbourhoods(faces: DataFrame, spots: DataFrame, value: str, side_m: float, exclusive: bool = False) -> DataFrame:
    """Per hotspot (rank, lat, lon): faces in the square of ``side_m`` around it, their mean, maximum and bounds.

    If ``exclusive``, a face in several squares counts for the best-ranked of their hotspots only, and a last row, of rank
    null, has all faces of the report together.

    Hotspots and faces meet on equal cells as large as the square, of which a hotspot lies in the few that it reaches into.
    """
    half = side_m / 2 / 111_000.0
    size = 2 * half
    cell = lambda c: F.floor(c / size).cast("int")
    at = spots.select("rank", F.col("lat").alias("y_"), F.col("lon").alias("x_")).dropna()
    reach = F.least(F.try_divide(F.lit(half), F.abs(F.cos(F.radians("y_")))), F.lit(360.0))  # all around at the poles
    at = at.withColumn("cy_", F.explode(F.sequence(cell(F.col("y_") - half), cell(F.col("y_") + half))))
    at = at.withColumn("cx_", F.explode(F.sequence(cell(F.col("x_") - F.coalesce(reach, F.lit(360.0))), cell(F.col("x_") + F.coalesce(reach, F.lit(360.0))))))
    near = (F.abs(F.col("lat") - F.col("y_")) <= half) & (F.abs(F.col("lon") - F.col("x_")) * F.cos(F.radians("y_")) <= half)
    joined = faces.withColumn("cy_", cell(F.col("lat"))).withColumn("cx_", cell(F.col("lon"))).join(at, ["cy_", "cx_"]).where(near)
    bounds = [f(c).alias(f"{c}_{f.__name__}") for c in ("lat", "lon") for f in (F.min, F.max)]
    if exclusive:
        first = joined.groupBy("face_id", "lat", "lon", value).agg(F.min("rank").alias("rank"))
        groups = first.rollup("rank")
    else:
        groups = joined.groupBy("rank")
    return groups.agg(F.count("*").alias("n_faces"), F.avg(value).alias("mean_value"), F.max(value).alias("max_value"), *bounds)


def planar_metres(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    return math.hypot((lat1 - lat2) * 111_000, (lon1 - lon2) * 111_000 * math.cos(math.radians(lat1)))
