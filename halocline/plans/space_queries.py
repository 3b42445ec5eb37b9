"""Keys and names, grids, searches, polygons and meshes."""

from __future__ import annotations

from pyspark.sql import functions as F

from halocline.functions import geo, names, styling
from halocline.operators import reshape, spatial
from halocline.plans.tables import ENDS_SQL, POINTS_SQL, TOP_SQL, Registry, end_points, points, rounded, table, top_point

REG = Registry()


@REG.add("partition_keys", f"""WITH {POINTS_SQL} SELECT face_id, printf('%08d', face_id) AS face_label, CAST(trunc(lat) AS INTEGER) AS lat_deg, CAST(trunc(lon) AS INTEGER) AS lon_deg,
    printf('%02d', CAST(floor((abs(lat) - floor(abs(lat))) * 100) AS BIGINT)) AS lat_dec, printf('%02d', CAST(floor((abs(lon) - floor(abs(lon))) * 100) AS BIGINT)) AS lon_dec FROM points""")
def partition_keys(spark, sf):
    return points(spark, sf).select("face_id", names.face_label("face_id").alias("face_label"), names.degree_key("lat").alias("lat_deg"), names.degree_key("lon").alias("lon_deg"), names.decimal_key("lat").alias("lat_dec"), names.decimal_key("lon").alias("lon_dec"))


PATH_SQL = "'lat_deg=' || CAST(trunc(lat) AS INTEGER) || '/lon_deg=' || CAST(trunc(lon) AS INTEGER) || '/lat_dec=' || printf('%02d', CAST(floor((abs(lat) - floor(abs(lat))) * 100) AS BIGINT)) || '/lon_dec=' || printf('%02d', CAST(floor((abs(lon) - floor(abs(lon))) * 100) AS BIGINT))"
FILE_SQL = "location || '.hindcast.face=' || printf('%08d', face_id) || '.lat=' || printf('%.7f', lat) || '.lon=' || printf('%.7f', lon) || '-1h.b4.v1.0.0.parquet'"


@REG.add("uri_columns", f"WITH {POINTS_SQL} SELECT face_id, 's3://bucket/' || location || '/' || {PATH_SQL} || '/' || {FILE_SQL} AS uri FROM points")
def uri_columns(spark, sf):
    return points(spark, sf).select("face_id", names.full_year_uri("s3://bucket/", "location", "face_id", "lat", "lon").alias("uri"))


@REG.add("filename_parse", f"WITH {POINTS_SQL} SELECT face_id, printf('%.7f', lat) AS lat, printf('%.7f', lon) AS lon, '1h' AS temporal, CAST(trunc(points.lat) AS INTEGER) AS lat_deg, CAST(floor((abs(points.lon) - floor(abs(points.lon))) * 100) AS INTEGER) AS lon_dec FROM points")
def filename_parse(spark, sf):
    uri = uri_columns(spark, sf)
    return uri.select(names.parse_point_file("uri").alias("f"), names.parse_partition_path("uri").alias("p")).select("f.*", "p.lat_deg", "p.lon_dec")


@REG.add("url_parse", r"SELECT page_id, regexp_extract(url, '^(https?)://', 1) AS scheme, regexp_extract(url, '://([^/?#]*)', 1) AS host, CAST(nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS BIGINT) AS number FROM pages")
def url_parse(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.regexp_extract("url", r"^(https?)://", 1).alias("scheme"), F.regexp_extract("url", r"://([^/?#]*)", 1).alias("host"), F.nullif(F.regexp_extract("url", r"/([0-9]+)", 1), F.lit("")).cast("long").alias("number"))


@REG.add("html_clean", r"""WITH t AS (SELECT page_id, html AS h FROM pages)
    SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(h, '<[^>]*>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM t""")
def html_clean(spark, sf):
    return table(spark, sf, "pages").select("page_id", names.clean_html("html").alias("text"))


@REG.add("hsds_time_string", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || '+00:00' AS time_index FROM events")
def hsds_time_string(spark, sf):
    return table(spark, sf, "events").select("event_id", names.hsds_time("ts").alias("time_index"))


@REG.add("color_class", "SELECT p_partkey AS face_id, CASE WHEN p_size * 12.5 < 50 THEN 'small' WHEN p_size * 12.5 < 500 THEN 'medium' ELSE 'large' END AS resolution_class, CAST(CASE WHEN p_retailprice >= 990 THEN 9 WHEN p_retailprice < 900 THEN 0 ELSE floor((p_retailprice - 900) / 10) END AS INTEGER) AS level FROM part")
def color_class(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("face_id"), styling.resolution_class(F.col("p_size") * 12.5).alias("resolution_class"), styling.level_of("p_retailprice", 900.0, 990.0, 9).alias("level"))


STOPS = [(68, 1, 84), (33, 145, 140), (253, 231, 37)]


@REG.add("fill_colors", f"""WITH l AS (SELECT p_partkey, p_size, p_retailprice AS v FROM part)
    SELECT p_partkey AS face_id, CASE WHEN p_size % 10 = 0 THEN '#000000' ELSE {styling.palette(STOPS, 9)}[CAST(least(CASE WHEN v >= 990 THEN 9 WHEN v < 900 THEN 0 ELSE floor((v - 900) / 10) END, 8) AS INTEGER) + 1] END AS color FROM l""")
def fill_colors(spark, sf):
    """Every tenth size has no value, half of those a NaN."""
    size = F.col("p_size")
    value = F.when(size % 20 == 0, float("nan")).when(size % 10 != 0, F.col("p_retailprice"))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("face_id"), styling.fill_color(value, 900.0, 990.0, 9, STOPS).alias("color"))


@REG.add("unit_standardize", "SELECT event_id, CASE event_type WHEN 'click' THEN 'm/s' WHEN 'view' THEN 'W/m^2' ELSE 'raw' END AS units FROM events")
def unit_standardize(spark, sf):
    variable = F.when(F.col("event_type") == "click", "mean_speed").when(F.col("event_type") == "view", "max_power_density").otherwise("other")
    return table(spark, sf, "events").select("event_id", styling.unit_of(variable, F.lit("raw")).alias("units"))


@REG.add("atlas_projection", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal, c_nationkey FROM customer")
def atlas_projection(spark, sf):
    return reshape.order_columns(table(spark, sf, "customer"), ["c_custkey", "c_name"])


@REG.add("normalize_lon", f"WITH {POINTS_SQL} SELECT face_id, round(((lon * 3 + 180) % 360 + 360) % 360 - 180, 6) + 0.0 AS lon FROM points")
def normalize_lon(spark, sf):
    return points(spark, sf).select("face_id", (F.round(geo.normalize_longitude(F.col("lon") * 3), 6) + 0.0).alias("lon"))


@REG.add("dateline_flag", f"WITH {POINTS_SQL}, t AS (SELECT face_id, lon AS a, ((lon + 1 + 180) % 360) - 180 AS b, ((lon + 2 + 180) % 360) - 180 AS c FROM points) SELECT face_id, greatest(a, b, c) - least(a, b, c) > 180 AS crosses FROM t")
def dateline_flag(spark, sf):
    lons = ["lon", geo.normalize_longitude(F.col("lon") + 1), geo.normalize_longitude(F.col("lon") + 2)]
    return points(spark, sf).select("face_id", geo.crosses_dateline(lons).alias("crosses"))


@REG.add("point_in_triangle", f"""WITH {POINTS_SQL}, t AS (SELECT face_id, lat AS y, lon + face_id % 7 * 0.6 AS x, lat - 1 AS y1, lon - 1 AS x1, lat + (face_id % 5) - 2 AS y2, lon + 2 AS x2, lat + 1.5 AS y3, lon - 1 AS x3 FROM points),
    b AS (SELECT *, (y2-y3)*(x1-x3) + (x3-x2)*(y1-y3) AS d FROM t), c AS (SELECT *, ((y2-y3)*(x-x3) + (x3-x2)*(y-y3)) / d AS p, ((y3-y1)*(x-x3) + (x1-x3)*(y-y3)) / d AS q FROM b)
    SELECT face_id, p >= -1e-10 AND q >= -1e-10 AND 1 - p - q >= -1e-10 AS inside FROM c""")
def point_in_triangle(spark, sf):
    lat, lon = F.col("lat"), F.col("lon")
    corners = [(lat - 1, lon - 1), (lat + (F.col("face_id") % 5) - 2, lon + 2), (lat + 1.5, lon - 1)]
    return points(spark, sf).select("face_id", geo.point_in_triangle("lat", lon + F.col("face_id") % 7 * 0.6, corners).alias("inside"))


@REG.add("web_mercator", f"WITH {POINTS_SQL} SELECT face_id, round(radians(lon) * 6378137.0, 3) + 0.0 AS x, round(ln(tan(pi() / 4 + radians(lat) / 2)) * 6378137.0, 3) + 0.0 AS y FROM points WHERE abs(lat) < 85")
def web_mercator(spark, sf):
    """The projection has no value at the poles; 85 degrees is its customary domain."""
    x, y = geo.web_mercator("lat", "lon")
    return points(spark, sf).where("abs(lat) < 85").select("face_id", (F.round(x, 3) + 0.0).alias("x"), (F.round(y, 3) + 0.0).alias("y"))


@REG.add("web_mercator_bounds", f"""WITH {POINTS_SQL} SELECT nation, count(*) AS n, round(min(lat), 6) + 0.0 AS lat_min, round(max(lat), 6) + 0.0 AS lat_max, round(min(lon), 6) + 0.0 AS lon_min, round(max(lon), 6) + 0.0 AS lon_max FROM points WHERE abs(lat) < 85 GROUP BY nation""")
def web_mercator_bounds(spark, sf):
    """Bounds of projected points, taken back to degrees."""
    x, y = geo.web_mercator("lat", "lon")
    b = points(spark, sf).where("abs(lat) < 85").select("nation", x.alias("x"), y.alias("y")).groupBy("nation").agg(F.count("*").alias("n"), *[f(c).alias(f"{c}_{n}") for c in "xy" for f, n in ((F.min, "min"), (F.max, "max"))])
    out = b.select("nation", "n", *[c.alias(f"{k}_{n}") for n in ("min", "max") for k, c in zip(("lat", "lon"), geo.web_mercator_inverse(f"x_{n}", f"y_{n}"), strict=True)])
    return rounded(out, "lat_min", "lat_max", "lon_min", "lon_max")


@REG.add("utm_zone", f"WITH {POINTS_SQL} SELECT face_id, CAST(CASE WHEN lat >= 56 AND lat < 64 AND lon >= 3 AND lon < 12 THEN 32 WHEN lat >= 72 AND lat < 84 AND lon >= 0 AND lon < 42 THEN CASE WHEN lon < 9 THEN 31 WHEN lon < 21 THEN 33 WHEN lon < 33 THEN 35 ELSE 37 END ELSE least(floor((lon + 180) / 6) + 1, 60) END AS INTEGER) AS zone FROM points")
def utm_zone(spark, sf):
    return points(spark, sf).select("face_id", geo.utm_zone("lat", "lon").alias("zone"))


HAVERSINE = "2 * 6371.0 * asin(least(1, sqrt(pow(sin(radians({b} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({b})) * pow(sin(radians({d} - {c}) / 2), 2))))"
FROM_HERE = HAVERSINE.format(a="12.345", b="lat", c="45.678", d="lon")


@REG.add("nearest_point", f"WITH {POINTS_SQL} SELECT face_id, lat, lon, round({FROM_HERE}, 6) AS distance_km FROM points ORDER BY {FROM_HERE}, face_id LIMIT 1")
def nearest_point(spark, sf):
    return spatial.nearest(points(spark, sf), 12.345, 45.678, anywhere=True).select("face_id", "lat", "lon", F.round("distance_km", 6).alias("distance_km"))


@REG.add("k_nearest", f"WITH {POINTS_SQL} SELECT face_id, round(sqrt(pow(lat - 12.345, 2) + pow(lon - 45.678, 2)), 6) AS distance_deg FROM points ORDER BY sqrt(pow(lat - 12.345, 2) + pow(lon - 45.678, 2)), face_id LIMIT 7")
def k_nearest(spark, sf):
    return rounded(spatial.k_nearest(points(spark, sf), 12.345, 45.678, 7).select("face_id", "distance_deg"), "distance_deg")


CELLS_SQL = f"""{POINTS_SQL},
    k AS (SELECT *, CAST(trunc(lat) AS INTEGER) AS lat_deg, CAST(trunc(lon) AS INTEGER) AS lon_deg, CAST(floor((abs(lat) - floor(abs(lat))) * 100) AS INTEGER) AS lat_dec,
                 CAST(floor((abs(lon) - floor(abs(lon))) * 100) AS INTEGER) AS lon_dec FROM points),
    cells AS (SELECT *, lat_deg || '_' || lon_deg || '_' || printf('%02d', lat_dec) || '_' || printf('%02d', lon_dec) AS grid_id,
                 lat_deg + (CASE WHEN lat < 0 THEN -1.0 ELSE 1.0 END::DOUBLE) * lat_dec * 0.01::DOUBLE AS y0, lon_deg + (CASE WHEN lon < 0 THEN -1.0 ELSE 1.0 END::DOUBLE) * lon_dec * 0.01::DOUBLE AS x0 FROM k),
    grid AS (SELECT grid_id, round(min(y0), 6) + 0.0 AS lat_min, round(min(x0), 6) + 0.0 AS lon_min, round(max(y0 + 0.01), 6) + 0.0 AS lat_max, round(max(x0 + 0.01), 6) + 0.0 AS lon_max, count(*) AS n FROM cells GROUP BY grid_id),
    ix AS (SELECT *, (lat_min + lat_max) / 2 AS centroid_lat, (lon_min + lon_max) / 2 AS centroid_lon FROM grid)"""


def index(spark, sf):
    return spatial.grid_index(spatial.grid_points(points(spark, sf)))


@REG.add("grid_index", f"WITH {CELLS_SQL} SELECT grid_id, lat_min, lon_min, lat_max, lon_max, n, round(centroid_lat, 6) + 0.0 AS centroid_lat, round(centroid_lon, 6) + 0.0 AS centroid_lon FROM ix")
def grid_index(spark, sf):
    return rounded(index(spark, sf), "lat_min", "lon_min", "lat_max", "lon_max", "centroid_lat", "centroid_lon")


@REG.add("grid_point_lists", f"WITH {CELLS_SQL} SELECT grid_id, location, list({{'face_id': printf('%08d', face_id), 'lat': printf('%.7f', lat), 'lon': printf('%.7f', lon)}} ORDER BY face_id) AS points FROM cells GROUP BY ALL")
def grid_point_lists(spark, sf):
    return spatial.grid_point_lists(spatial.grid_points(points(spark, sf)))


@REG.add("grid_boxes", f"""WITH {CELLS_SQL} SELECT floor(centroid_lat / 10) * 10 AS box_lat, floor(centroid_lon / 10) * 10 AS box_lon, round(min(centroid_lat) - 0.005, 6) + 0.0 AS lat_min, round(max(centroid_lat) + 0.005, 6) + 0.0 AS lat_max,
    round(min(centroid_lon) - 0.005, 6) + 0.0 AS lon_min, round(max(centroid_lon) + 0.005, 6) + 0.0 AS lon_max, count(*) AS n_cells, CAST(sum(n) AS BIGINT) AS n_points FROM ix GROUP BY 1, 2""")
def grid_boxes(spark, sf):
    out = rounded(spatial.grid_boxes(index(spark, sf), 10.0), "lat_min", "lat_max", "lon_min", "lon_max")
    return out.withColumns({c: F.col(c).cast("double") + 0.0 for c in ("box_lat", "box_lon")})


#: A box around the point with the greatest value.
BOX_SQL = f"{TOP_SQL}, box AS (SELECT lat0 - 20 AS a, lat0 + 10 AS b, lon0 - 60 AS c, lon0 + 45 AS d FROM top)"
AREA_SQL = "sqrt(pow(greatest(a - centroid_lat, centroid_lat - b, 0), 2) + pow(greatest(c - centroid_lon, centroid_lon - d, 0), 2))"


def box(spark, sf):
    lat, lon = top_point(spark, sf)
    return lat - 20, lat + 10, lon - 60, lon + 45


@REG.add("area_query", f"WITH {CELLS_SQL}, {BOX_SQL} SELECT grid_id, n FROM ix, box WHERE {AREA_SQL} <= 2.345")
def area_query(spark, sf):
    return spatial.within_area(index(spark, sf), *box(spark, sf), 2.345).select("grid_id", "n")


@REG.add("area_edge_query", f"WITH {CELLS_SQL}, {BOX_SQL} SELECT grid_id, n FROM ix, box WHERE CASE WHEN centroid_lat BETWEEN a AND b AND centroid_lon BETWEEN c AND d THEN least(centroid_lat - a, b - centroid_lat, centroid_lon - c, d - centroid_lon) <= 2.345 ELSE {AREA_SQL} <= 2.345 END")
def area_edge_query(spark, sf):
    return spatial.within_area(index(spark, sf), *box(spark, sf), 2.345, edges_only=True).select("grid_id", "n")


#: From the face with the least id to that with the greatest.
LINE_SQL = f"""{ENDS_SQL}, u AS (SELECT *, lat2 - lat1 AS dy, lon2 - lon1 AS dx, sqrt(pow(lat2 - lat1, 2) + pow(lon2 - lon1, 2)) AS far FROM ends),
    line AS (SELECT ix.*, far, ((centroid_lon - lon1) * dx + (centroid_lat - lat1) * dy) / far AS along, abs((centroid_lon - lon1) * dy - (centroid_lat - lat1) * dx) / far AS across FROM ix, u)"""


@REG.add("line_query", f"WITH {CELLS_SQL}, {LINE_SQL} SELECT grid_id, round(along, 6) + 0.0 AS along, round(across, 6) + 0.0 AS across FROM line WHERE across <= 3.21 AND along BETWEEN -3.21 AND far + 3.21 ORDER BY round(line.across, 9), grid_id LIMIT 10")
def line_query(spark, sf):
    return rounded(spatial.along_line(index(spark, sf), *end_points(spark, sf), 3.21, 10).select("grid_id", "along", "across"), "along", "across")


@REG.add("boundary_edges", """WITH n AS (SELECT l_orderkey AS face_id, l_linenumber AS corner, l_partkey % 50 AS node FROM lineitem WHERE l_linenumber <= 3),
    f AS (SELECT face_id, list(node ORDER BY corner) AS c FROM n GROUP BY face_id HAVING count(*) = 3),
    e AS (SELECT least(c[1], c[2]) AS a, greatest(c[1], c[2]) AS b FROM f UNION ALL SELECT least(c[2], c[3]), greatest(c[2], c[3]) FROM f UNION ALL SELECT least(c[1], c[3]), greatest(c[1], c[3]) FROM f)
    SELECT a, b FROM e GROUP BY a, b HAVING count(*) = 1""")
def boundary_edges(spark, sf):
    n = table(spark, sf, "lineitem").where("l_linenumber <= 3").select(F.lit(1).alias("mesh"), F.col("l_orderkey").alias("face_id"), F.col("l_linenumber").alias("corner"), (F.col("l_partkey") % 50).alias("node_id"))
    whole = n.groupBy("face_id").agg(F.count("*").alias("k")).where("k = 3").select("face_id")
    return spatial.boundary_edges(n.join(whole, "face_id", "left_semi"), ["mesh"]).select("a", "b")


def rings(spark, sf):
    key = F.col("n_nationkey")
    lon, lat = key * 14 - 175, (key * 7) % 140 - 70
    point = lambda x, y: F.struct((lon + x).cast("double").alias("lon"), (lat + y).cast("double").alias("lat"))
    return table(spark, sf, "nation").select(F.col("n_name").alias("boundary"), F.array(point(0, 0), point(13, 2), point(6, 5), point(11, 17), point(-1, 12)).alias("ring"))


@REG.add("path_distance", f"""WITH {POINTS_SQL}, s AS (SELECT *, lag(lat) OVER w AS a, lag(lon) OVER w AS o FROM points WINDOW w AS (PARTITION BY nation ORDER BY face_id))
    SELECT face_id, round(sum(coalesce({HAVERSINE.format(a="a", b="lat", c="o", d="lon")}, 0)) OVER (PARTITION BY nation ORDER BY face_id ROWS UNBOUNDED PRECEDING), 4) AS distance_km FROM s""")
def path_distance(spark, sf):
    return spatial.path_distance(points(spark, sf), ["nation"], "face_id").select("face_id", F.round("distance_km", 4).alias("distance_km"))


def transect_start(spark, sf):
    lat, lon = top_point(spark, sf)
    return lat + 0.25, lon + 0.4


@REG.add("transect", f"""WITH {POINTS_SQL}, {TOP_SQL}, o AS (SELECT lat0 + 0.25::DOUBLE AS oy, lon0 + 0.4::DOUBLE AS ox FROM top), t AS (SELECT face_id, (lat - oy) * 111 AS y, (lon - ox) * 111 * cos(radians(oy)) AS x, 55.5::DOUBLE * cos(radians(oy)) AS half FROM points, o),
    c AS (SELECT face_id, [y, y + 111, y] AS ys, [x, x + half, x + 2 * half] AS xs FROM t),
    s AS (SELECT face_id, list_transform([1, 2, 3], lambda i: xs[i] * cos(radians(60)) - ys[i] * sin(radians(60))) AS side, list_transform([1, 2, 3], lambda i: ys[i] * cos(radians(60)) + xs[i] * sin(radians(60))) AS along FROM c)
    SELECT face_id, round(list_sum(along) / 3, 6) + 0.0 AS distance_km FROM s WHERE list_min(side) <= 0 AND list_max(side) >= 0 AND list_max(along) >= 0 AND list_min(along) <= 5000""")
def transect(spark, sf):
    """From within the face with the greatest value."""
    p = points(spark, sf).withColumns({"la2": F.col("lat") + 1, "lo2": F.col("lon") + 0.5, "lo3": F.col("lon") + 1})
    return rounded(spatial.transect(p, transect_start(spark, sf), 60.0, 5000.0, [("lat", "lon"), ("la2", "lo2"), ("lat", "lo3")]).select("face_id", "distance_km"), "distance_km")


@REG.add("hotspots_greedy", f"""WITH RECURSIVE {POINTS_SQL}, pick AS (
    SELECT 1 AS rank, best.*, [best.lat] AS ys, [best.lon] AS xs FROM (SELECT arg_max(struct_pack(face_id, lat, lon, value), (value, -face_id)) AS best FROM points)
    UNION ALL
    SELECT rank + 1, best.*, list_append(ys, best.lat), list_append(xs, best.lon) FROM (
        SELECT k.rank, k.ys, k.xs, arg_max(struct_pack(face_id := q.face_id, lat := q.lat, lon := q.lon, value := q.value), (q.value, -q.face_id)) AS best FROM pick k, points q
        WHERE k.rank < 10 AND list_bool_and(list_transform(generate_series(1, len(k.ys)), lambda i: sqrt(pow((q.lat - k.ys[i]) * 111000, 2) + pow((q.lon - k.xs[i]) * 111000 * cos(radians(q.lat)), 2)) >= 500000)) GROUP BY ALL))
    SELECT CAST(rank AS INTEGER) AS rank, face_id, lat, lon, value, 500000.0::DOUBLE AS spacing_m FROM pick""")
def hotspots_greedy(spark, sf):
    return spatial.hotspots(points(spark, sf), "value", 10, 500_000.0)


# Vincenty's inverse, iterated row by row; at a pole an edge along the parallel has no length.
GEODESIC_SQL = f"""WITH RECURSIVE {POINTS_SQL}, k AS (SELECT 1 / 298.257223563::DOUBLE AS f, 6378137.0::DOUBLE AS a),
    v AS (SELECT face_id, [lat, least(lat + 0.1, 90), lat] AS ys, [lon, lon, lon + 0.1] AS xs FROM points),
    e AS (SELECT face_id, i, ys[i] AS y1, xs[i] AS x1, ys[i % 3 + 1] AS y2, xs[i % 3 + 1] AS x2 FROM v, (SELECT unnest([1, 2, 3]) AS i)),
    r AS (SELECT face_id, i, f, a, atan((1 - f) * tan(radians(y1))) AS u1, atan((1 - f) * tan(radians(y2))) AS u2, radians(x2 - x1) AS dl FROM e, k),
    it AS (SELECT face_id, i, f, a, u1, u2, dl, dl AS lam, 0 AS n FROM r UNION ALL
        SELECT face_id, i, f, a, u1, u2, dl, dl + (1 - c) * f * sa * (s + c * ss * (cm + c * cs * (2 * cm * cm - 1))), n + 1 FROM (
            SELECT *, atan2(ss, cs) AS s, f / 16 * c2 * (4 + f * (4 - 3 * c2)) AS c, CASE WHEN c2 > 1e-15 THEN cs - 2 * sin(u1) * sin(u2) / c2 ELSE 0 END AS cm FROM (
                SELECT *, CASE WHEN ss > 0 THEN cos(u1) * cos(u2) * sin(lam) / ss ELSE 0 END AS sa, 1 - sa * sa AS c2 FROM (
                    SELECT *, sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS ss, sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs FROM it WHERE n < 12)))),
    z AS (SELECT *, sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS ss, sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs FROM it WHERE n = 12),
    y AS (SELECT *, atan2(ss, cs) AS s, a * (1 - f) AS b, CASE WHEN ss > 0 THEN cos(u1) * cos(u2) * sin(lam) / ss ELSE 0 END AS sa, 1 - sa * sa AS c2, CASE WHEN c2 > 1e-15 THEN cs - 2 * sin(u1) * sin(u2) / c2 ELSE 0 END AS cm, c2 * (a * a - b * b) / (b * b) AS w,
                 1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w))) AS big, w / 1024 * (256 + w * (-128 + w * (74 - 47 * w))) AS small FROM z),
    m AS (SELECT face_id, i, b * big * (s - small * ss * (cm + small / 4 * (cs * (2 * cm * cm - 1) - small / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))) AS metres FROM y)
    SELECT face_id, round(sum(metres) / 3, 1) + 0.0 AS grid_resolution_m FROM m GROUP BY face_id"""


@REG.add("geodesic_edges", GEODESIC_SQL)
def geodesic_edges(spark, sf):
    p = points(spark, sf).withColumns({"la2": F.least(F.col("lat") + 0.1, F.lit(90.0)), "lo2": F.col("lon") + 0.1})
    return rounded(p.select("face_id", geo.grid_resolution([("lat", "lon"), ("la2", "lon"), ("lat", "lo2")]).alias("grid_resolution_m")), "grid_resolution_m", digits=1)


# The Krueger series written out: with xi and eta the scaled northing and easting, chi the conformal latitude.
UTM_SQL = f"""WITH {POINTS_SQL}, k AS (SELECT 1 / (2 * 298.257223563::DOUBLE - 1) AS n),
    s AS (SELECT face_id, n, abs(lat) * 110000 / r AS xi, (500000 + lon * 1000 - 500000) / r AS eta FROM points, (SELECT n, 0.9996::DOUBLE * 6378137 / (1 + n) * (1 + pow(n, 2) / 4 + pow(n, 4) / 64) AS r FROM k)),
    c AS (SELECT *, n / 2 - 2 * pow(n, 2) / 3 + 37 * pow(n, 3) / 96 AS b1, pow(n, 2) / 48 + pow(n, 3) / 15 AS b2, 17 * pow(n, 3) / 480 AS b3 FROM s),
    d AS (SELECT *, xi - b1 * sin(2 * xi) * cosh(2 * eta) - b2 * sin(4 * xi) * cosh(4 * eta) - b3 * sin(6 * xi) * cosh(6 * eta) AS x, eta - b1 * cos(2 * xi) * sinh(2 * eta) - b2 * cos(4 * xi) * sinh(4 * eta) - b3 * cos(6 * xi) * sinh(6 * eta) AS e FROM c),
    f AS (SELECT *, asin(sin(x) / cosh(e)) AS chi FROM d)
    SELECT face_id, round(degrees(chi + (2 * n - 2 * pow(n, 2) / 3 - 2 * pow(n, 3)) * sin(2 * chi) + (7 * pow(n, 2) / 3 - 8 * pow(n, 3) / 5) * sin(4 * chi) + 56 * pow(n, 3) / 15 * sin(6 * chi)), 8) + 0.0 AS lat,
           round(degrees(atan2(sinh(e), cos(x))) - 69, 8) + 0.0 AS lon FROM f"""


@REG.add("utm_inverse", UTM_SQL)
def utm_inverse(spark, sf):
    p = points(spark, sf)
    lat, lon = geo.utm_inverse(F.lit(500_000.0) + F.col("lon") * 1000, F.abs("lat") * 110_000, 19)
    return rounded(p.select("face_id", lat.alias("lat"), lon.alias("lon")), "lat", "lon", digits=8)


# A triangle (lon, lat), (lon + 2, lat + 1), (lon + 4, lat) that crosses the date line at ``d`` degrees from its west corner.
SPLIT_SQL = f"""WITH {POINTS_SQL}, t AS (SELECT face_id, lat, lon + 0.003 AS lon, 180 - (lon + 0.003) AS d FROM points),
    whole AS (SELECT face_id, 1 AS split_part, 1 AS split_total, unnest([0, 1, 2]) AS place, unnest([lon, lon + 2, lon + 4]) AS lon, unnest([lat, lat + 1, lat]) AS lat FROM t WHERE d >= 4),
    cut AS (SELECT *, lat + CASE WHEN d < 2 THEN d / 2 ELSE (4 - d) / 2 END AS up FROM t WHERE d < 4),
    p AS (SELECT face_id, 1 AS split_part, unnest([(lon, lat), (179.999::DOUBLE, up), (179.999::DOUBLE, lat)]) AS p FROM cut UNION ALL SELECT face_id, 1, (lon + 2, lat + 1) FROM cut WHERE d > 2
        UNION ALL SELECT face_id, 2, unnest([(lon + 4, lat), (180.001::DOUBLE, up), (180.001::DOUBLE, lat)]) FROM cut UNION ALL SELECT face_id, 2, (lon + 2, lat + 1) FROM cut WHERE d < 2),
    c AS (SELECT *, avg(p[1]) OVER w AS cx, avg(p[2]) OVER w AS cy FROM p WINDOW w AS (PARTITION BY face_id, split_part)),
    parts AS (SELECT face_id, split_part, 2 AS split_total, row_number() OVER (PARTITION BY face_id, split_part ORDER BY atan2(p[2] - cy, p[1] - cx)) - 1 AS place, p[1] - CASE split_part WHEN 2 THEN 360 ELSE 0 END AS lon, p[2] AS lat FROM c)
    SELECT face_id, CAST(split_part AS INTEGER) AS split_part, CAST(split_total AS INTEGER) AS split_total, CAST(place AS INTEGER) AS place, round(lon, 6) + 0.0 AS lon, round(lat, 6) + 0.0 AS lat FROM (FROM whole UNION ALL FROM parts)"""


@REG.add("dateline_split", SPLIT_SQL)
def dateline_split(spark, sf):
    """The corners of each part in order."""
    p = points(spark, sf).withColumn("lon", F.col("lon") + 0.003)
    p = p.withColumns({"la2": F.col("lat") + 1, "lo2": geo.normalize_longitude(F.col("lon") + 2), "lo3": geo.normalize_longitude(F.col("lon") + 4)})
    parts = spatial.split_dateline(p.select("face_id", "lat", "lon", "la2", "lo2", "lo3"), [("lat", "lon"), ("la2", "lo2"), ("lat", "lo3")])
    corners = parts.select("face_id", "split_part", "split_total", F.posexplode("ring").alias("place", "p"))
    return rounded(corners.select("face_id", "split_part", "split_total", "place", "p.lon", "p.lat"), "lon", "lat")
