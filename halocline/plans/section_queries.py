"""Sections through a mesh of the driver's points and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from halocline.functions import names
from halocline.operators import derive, sections
from halocline.plans.space_queries import transect_start
from halocline.plans.tables import POINTS_SQL, TOP_SQL, Registry, points, rounded, table, top_point

REG = Registry()


@REG.add("face_corners", """WITH n AS (SELECT l_orderkey AS face_id, l_linenumber AS c, l_partkey AS node FROM lineitem WHERE l_linenumber <= 3), p AS (SELECT p_partkey AS node, p_size * 1.5 - 40 AS lat, p_retailprice - 950 AS lon FROM part)
    SELECT face_id, max(lat) FILTER (c = 1) AS element_corner_1_lat, max(lon) FILTER (c = 1) AS element_corner_1_lon, max(lat) FILTER (c = 2) AS element_corner_2_lat, max(lon) FILTER (c = 2) AS element_corner_2_lon,
           max(lat) FILTER (c = 3) AS element_corner_3_lat, max(lon) FILTER (c = 3) AS element_corner_3_lon FROM n JOIN p USING (node) GROUP BY face_id""")
def face_corners(spark, sf):
    """Three corners a face: the feature."""
    n = table(spark, sf, "lineitem").where("l_linenumber <= 3").select(F.lit("m").alias("location"), F.col("l_orderkey").alias("face_id"), F.col("l_linenumber").alias("corner"), F.col("l_partkey").alias("node_id"))
    p = table(spark, sf, "part").select(F.lit("m").alias("location"), F.col("p_partkey").alias("node_id"), (F.col("p_size") * 1.5 - 40).alias("lat_node"), (F.col("p_retailprice") - 950).alias("lon_node"))
    return derive.corner_columns(n, p, ["location", "face_id"]).drop("location")


@REG.add("path_templates", """SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN replace(replace('{level}/{location}/v1.0.0/' || CASE WHEN o_orderkey % 4 = 1 THEN '{level}.nc' ELSE 'x.nc' END, '{level}', 'b' || o_orderkey % 7), '{location}', o_orderpriority) END AS path
    FROM orders""")
def path_templates(spark, sf):
    """Every fourth template has a place that nothing fills."""
    k = F.col("o_orderkey")
    template = F.concat(F.lit("{level}/{location}/v1.0.0/"), F.when(k % 4 == 1, "{level}.nc").when(k % 4 == 0, "{unknown}.nc").otherwise("x.nc"))
    path = names.render_template(template, {"level": F.concat(F.lit("b"), (k % 7).cast("string")), "location": "o_orderpriority"})
    return table(spark, sf, "orders").select("o_orderkey", path.alias("path"))

#: Triangles with a corner at each point; the layers of corner i are the embedding's numbers from 1 + 20 i (u) and 11 + 20 i (v),
#: and lie closer to each other near the surface.
N_LAYERS = 10


def layer_share(k):
    return F.pow((k + 0.5) / N_LAYERS, F.lit(1.5))


def scaled(depth: str):
    return lambda share: share * F.col(depth)


def mesh(spark, sf):
    part = lambda first: F.transform(F.slice("embedding", first, N_LAYERS), lambda x: x.cast("double"))
    p = points(spark, sf).withColumns({"la1": F.col("lat") + 8, "lo1": F.col("lon") + 2, "la2": F.col("lat"), "lo2": F.col("lon") + 8})
    e = table(spark, sf, "embeddings").select(F.col("vec_id"), *[part(1 + 20 * i + 10 * k).alias(f"{c}{i}") for i in range(3) for k, c in enumerate("uv")])
    out = p.join(e, F.col("face_id") % 500 == F.col("vec_id")).withColumns({f"h{i}": 20 + F.pmod(F.col("face_id") * (i + 3), F.lit(17)).cast("double") for i in range(3)})
    # layer k lies at ((k + 0.5) / 10) ** 1.5 of the depth
    return out.withColumns({f"d{i}": F.transform(F.sequence(F.lit(0), F.lit(N_LAYERS - 1)), layer_share) for i in range(3)}).withColumns({f"d{i}": F.transform(f"d{i}", scaled(f"h{i}")) for i in range(3)})


MESH_SQL = f"""{POINTS_SQL}, {TOP_SQL},
    mesh AS (SELECT face_id, lat AS y0, lon AS x0, lat + 8 AS y1, lon + 2 AS x1, lat AS y2, lon + 8 AS x2, list_transform(embedding, lambda x: x::DOUBLE) AS e,
                    20.0::DOUBLE + face_id * 3 % 17 AS h0, 20.0::DOUBLE + face_id * 4 % 17 AS h1, 20.0::DOUBLE + face_id * 5 % 17 AS h2 FROM points JOIN embeddings ON vec_id = face_id % 500)"""

SECTION_SQL = f"""WITH {MESH_SQL},
    w AS (SELECT i AS position, lat0, lon0, lat0 + 1 + i / 99::DOUBLE * 10 AS lat, lon0 + 2 + i / 99::DOUBLE * 20 AS lon FROM generate_series(0, 99) AS g(i), top),
    b AS (SELECT w.position, m.*, ((y1 - y2) * (w.lon - x2) + (x2 - x1) * (w.lat - y2)) / ((y1 - y2) * (x0 - x2) + (x2 - x1) * (y0 - y2)) AS p, ((y2 - y0) * (w.lon - x2) + (x0 - x2) * (w.lat - y2)) / ((y1 - y2) * (x0 - x2) + (x2 - x1) * (y0 - y2)) AS q
        FROM w JOIN mesh m ON w.lat BETWEEN y0 AND y1 AND w.lon BETWEEN x0 AND x2),
    c AS (SELECT * FROM b WHERE p >= -1e-10 AND q >= -1e-10 AND 1 - p - q >= -1e-10 QUALIFY row_number() OVER (PARTITION BY position ORDER BY face_id) = 1),
    col AS (SELECT position, face_id, p * h0 + q * h1 + (1 - p - q) * h2 AS floor, list_transform(generate_series(1, 10), lambda k: pow((k - 0.5) / 10::DOUBLE, 1.5) * p * h0 + pow((k - 0.5) / 10::DOUBLE, 1.5) * q * h1 + pow((k - 0.5) / 10::DOUBLE, 1.5) * (1 - p - q) * h2) AS d,
        list_transform(generate_series(1, 10), lambda k: p * e[k] + q * e[k + 20] + (1 - p - q) * e[k + 40]) AS u, list_transform(generate_series(1, 10), lambda k: p * e[k + 10] + q * e[k + 30] + (1 - p - q) * e[k + 50]) AS v FROM c),
    r AS (SELECT position, face_id, floor, CAST(level AS INTEGER) AS level, level * (SELECT max(floor) FROM col) / 12::DOUBLE AS depth, d, u, v FROM w LEFT JOIN col USING (position), generate_series(0, 12) AS l(level)),
    n AS (SELECT *, len(list_filter(d, lambda x: x <= depth)) AS above FROM r),
    f AS (SELECT *, greatest(above, 1) AS i, least(above + 1, 10) AS j FROM n),
    g AS (SELECT *, CASE WHEN i = j THEN 0 ELSE least(greatest((depth - d[i]) / (d[j] - d[i]), 0), 1) END AS s FROM f),
    x AS (SELECT *, CASE WHEN depth <= floor THEN u[i] + s * (u[j] - u[i]) END AS uu, CASE WHEN depth <= floor THEN v[i] + s * (v[j] - v[i]) END AS vv FROM g),
    a AS (SELECT 20 * cos(radians(lat0 + 6)) AS east FROM top), o AS (SELECT east / sqrt(east * east + 100) AS ux, 10 / sqrt(east * east + 100) AS uy FROM a)
    SELECT position, level, round(depth, 6) + 0.0 AS depth_m, face_id, round(floor, 6) + 0.0 AS floor_m, round(sqrt(uu * uu + vv * vv), 6) + 0.0 AS speed, round(uu * ux + vv * uy, 6) + 0.0 AS along, round(vv * ux - uu * uy, 6) + 0.0 AS across FROM x, o"""


@REG.add("cross_section", SECTION_SQL)
def cross_section(spark, sf):
    """From within the face with the greatest value, 10 degrees north and 20 east."""
    lat, lon = top_point(spark, sf)
    three = lambda name: [f"{name}{i}" for i in range(3)]
    out = sections.cross_section(mesh(spark, sf), (lat + 1, lon + 2), (lat + 11, lon + 22), 100, 13, [("lat", "lon"), ("la1", "lo1"), ("la2", "lo2")], three("h"), three("d"), three("u"), three("v"))
    return rounded(out.select("position", "level", "depth_m", "face_id", "floor_m", "speed", "along", "across"), "depth_m", "floor_m", "speed", "along", "across")


MATRIX_SQL = f"""WITH {MESH_SQL}, o AS (SELECT lat0 + 0.25::DOUBLE AS oy, lon0 + 0.4::DOUBLE AS ox FROM top),
    t AS (SELECT face_id, e, h0, list_transform([y0, y1, y2], lambda y: (y - oy) * 111) AS ys, list_transform([x0, x1, x2], lambda x: (x - ox) * 111 * cos(radians(oy))) AS xs FROM mesh, o),
    s AS (SELECT *, list_transform([1, 2, 3], lambda i: xs[i] * cos(radians(60)) - ys[i] * sin(radians(60))) AS side, list_transform([1, 2, 3], lambda i: ys[i] * cos(radians(60)) + xs[i] * sin(radians(60))) AS along FROM t),
    c AS (SELECT face_id, e, h0, list_sum(along) / 3 AS x FROM s WHERE list_min(side) <= 0 AND list_max(side) >= 0 AND list_max(along) >= -5000 AND list_min(along) <= 5000),
    g AS (SELECT *, x < 0 AS back, abs(x) - lag(abs(x)) OVER (PARTITION BY x < 0 ORDER BY abs(x)) AS step FROM c),
    m AS (SELECT back, avg(step) + 2 * stddev_pop(step) AS most FROM g GROUP BY back), z AS (SELECT back, min(abs(x)) AS cut FROM g JOIN m USING (back) WHERE step > most GROUP BY back),
    k AS (SELECT g.* FROM g LEFT JOIN z ON g.back = z.back WHERE cut IS NULL OR abs(x) < cut),
    w AS (SELECT *, row_number() OVER o AS position, (x - lag(x) OVER o) / 2 AS hb, (lead(x) OVER o - x) / 2 AS ha FROM k WINDOW o AS (ORDER BY x, face_id)),
    l AS (SELECT w.*, i, pow((i - 0.5) / 10::DOUBLE, 1.5) * h0 AS d, pow((i - 1.5) / 10::DOUBLE, 1.5) * h0 AS dup, pow((i + 0.5) / 10::DOUBLE, 1.5) * h0 AS dlow FROM w, (SELECT unnest(generate_series(1, 10)) AS i)),
    y AS (SELECT *, CASE WHEN i > 1 THEN (d - dup) / 2 END AS up, CASE WHEN i < 10 THEN (dlow - d) / 2 END AS down FROM l)
    SELECT CAST(position AS INTEGER) AS position, face_id, round(x, 6) + 0.0 AS distance_km, round(x - coalesce(hb, ha, 0.5), 6) + 0.0 AS from_km, round(x + coalesce(ha, hb, 0.5), 6) + 0.0 AS to_km, CAST(i - 1 AS INTEGER) AS sigma_layer, round(d, 6) + 0.0 AS depth_m,
           round(d - coalesce(up, down), 6) + 0.0 AS top_m, round(d + coalesce(down, up), 6) + 0.0 AS bottom_m, e[i] AS value FROM y"""


@REG.add("transect_matrix", MATRIX_SQL)
def transect_matrix(spark, sf):
    out = sections.transect_matrix(mesh(spark, sf), transect_start(spark, sf), 60.0, 5000.0, [("lat", "lon"), ("la1", "lo1"), ("la2", "lo2")], "d0", "u0", shore_deviations=2.0)
    return rounded(out, "distance_km", "from_km", "to_km", "depth_m", "top_m", "bottom_m")
