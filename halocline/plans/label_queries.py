"""Labels, names and outlines of points, lines and files."""

from __future__ import annotations

from pyspark.sql import functions as F

from halocline.functions import geo, names
from halocline.operators import reshape, spatial
from halocline.plans.space_queries import rings
from halocline.plans.tables import POINTS_SQL, Registry, points, rounded, table
from halocline.sources import writers

REG = Registry()

@REG.add("line_outlines", f"""WITH {POINTS_SQL}, s AS (SELECT face_id // 20 AS line, lat, lon, abs(lon - lag(lon) OVER (PARTITION BY face_id // 20 ORDER BY face_id)) > 180 AS jump FROM points),
    g AS (SELECT line, coalesce(bool_or(jump), false) AS crosses, min(lon) AS x1, max(lon) AS x2, min(lat) AS y1, max(lat) AS y2 FROM s GROUP BY line)
    SELECT line, round(CASE WHEN crosses THEN -180 ELSE x1 END, 6) + 0.0 AS lon_min, round(CASE WHEN crosses THEN 180 ELSE x2 END, 6) + 0.0 AS lon_max, round(CASE WHEN crosses THEN y1 - 2 ELSE y1 END, 6) + 0.0 AS lat_min, round(CASE WHEN crosses THEN y2 + 2 ELSE y2 END, 6) + 0.0 AS lat_max FROM g""")
def line_outlines(spark, sf):
    p = points(spark, sf).withColumn("line", F.floor(F.col("face_id") / 20))
    lines = p.groupBy("line").agg(F.array_sort(F.collect_list(F.struct("face_id", "lon", "lat"))).alias("p"))  # 20 points a line
    lines = lines.select("line", F.transform("p", lambda x: F.struct(x["lon"].alias("lon"), x["lat"].alias("lat"))).alias("p"))
    ring = lines.select("line", spatial.line_outline("p").alias("ring"))
    ends = {f"{c}_{f.__name__[-3:]}": f(F.col("ring")[c]) for c in ("lon", "lat") for f in (F.array_min, F.array_max)}
    return rounded(ring.select("line", *[v.alias(k) for k, v in ends.items()]), *ends)


@REG.add("face_index", "SELECT o_orderpriority AS location, o_custkey AS face_id, max(o_orderkey) AS record, arg_max(o_totalprice, o_orderkey) AS value FROM orders GROUP BY ALL")
def face_index(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("location"), F.col("o_custkey").alias("face_id"), F.col("o_orderkey").alias("record"), F.col("o_totalprice").alias("value"))
    return reshape.last_record(o, ["location", "face_id"], ["record"])


@REG.add("bounds_summary", f"""WITH {POINTS_SQL}, b AS (SELECT nation, min(lat) AS a, max(lat) AS b, min(lon) AS c, max(lon) AS d FROM points GROUP BY nation)
    SELECT nation, round(a - (b - a) * 0.1::DOUBLE, 6) + 0.0 AS lat_min, round(b + (b - a) * 0.1::DOUBLE, 6) + 0.0 AS lat_max, round(c - (d - c) * 0.1::DOUBLE, 6) + 0.0 AS lon_min, round(d + (d - c) * 0.1::DOUBLE, 6) + 0.0 AS lon_max,
           round((a + b) / 2, 6) + 0.0 AS lat_mid, round((c + d) / 2, 6) + 0.0 AS lon_mid FROM b""")
def bounds_summary(spark, sf):
    b = points(spark, sf).groupBy("nation").agg(*[f(c).alias(f"{c}_{n}") for c in ("lat", "lon") for f, n in ((F.min, "lo"), (F.max, "hi"))])
    out = ["nation"]
    for c in ("lat", "lon"):
        lo, hi = geo.buffered(f"{c}_lo", f"{c}_hi", 10)
        out += [lo.alias(f"{c}_min"), hi.alias(f"{c}_max"), ((F.col(f"{c}_lo") + F.col(f"{c}_hi")) / 2).alias(f"{c}_mid")]
    b = b.select(*out)
    return rounded(b, *b.columns[1:])


WRAPPED_SQL = "t AS (SELECT face_id, lon AS a, ((lon + 50 + 180) % 360) - 180 AS b, ((lon + 100 + 180) % 360) - 180 AS c FROM points)"


def wrapped():
    return [F.col("lon"), geo.normalize_longitude(F.col("lon") + 50), geo.normalize_longitude(F.col("lon") + 100)]


@REG.add("hemisphere_shift", f"""WITH {POINTS_SQL}, {WRAPPED_SQL}, s AS (SELECT *, (a < 0)::INT + (b < 0)::INT + (c < 0)::INT >= (a > 0)::INT + (b > 0)::INT + (c > 0)::INT AS west FROM t)
    SELECT face_id, {", ".join(f"round(CASE WHEN west AND {x} > 0 THEN {x} - 360 WHEN NOT west AND {x} < 0 THEN {x} + 360 ELSE {x} END, 6) + 0.0 AS {x}" for x in "abc")} FROM s""")
def hemisphere_shift(spark, sf):
    p = points(spark, sf).select("face_id", geo.one_hemisphere(F.array(*wrapped())).alias("x"))
    return rounded(p.select("face_id", *[F.col("x")[i].alias(n) for i, n in enumerate("abc")]), *"abc")


@REG.add("dateline_unwrap", f"""WITH {POINTS_SQL}, {WRAPPED_SQL}, s AS (SELECT *, greatest(a, b, c) - least(a, b, c) > 180 AS wide, (a + b + c) / 3 >= 0 AS east FROM t)
    SELECT face_id, {", ".join(f"round(CASE WHEN wide AND east AND {x} < 0 THEN {x} + 360 WHEN wide AND NOT east AND {x} > 0 THEN {x} - 360 ELSE {x} END, 6) + 0.0 AS {x}" for x in "abc")} FROM s""")
def dateline_unwrap(spark, sf):
    return rounded(points(spark, sf).select("face_id", *[c.alias(n) for c, n in zip(geo.unwrap_longitudes(wrapped()), "abc", strict=True)]), *"abc")


ZONES = ("America/Anchorage", "America/Adak", "America/Los_Angeles", "America/New_York", "America/St_Johns", "UTC", "Asia/Kolkata")


@REG.add("utc_offsets", f"""WITH z AS (SELECT n_nationkey, {list(ZONES)}[n_nationkey % {len(ZONES)} + 1] AS zone, TIMESTAMP '2023-01-15 12:00:00' AS noon FROM nation)
    SELECT n_nationkey, CAST(trunc(date_diff('minute', noon, (noon AT TIME ZONE 'UTC') AT TIME ZONE zone) / 60) AS INTEGER) AS offset_hours FROM z""")
def utc_offsets(spark, sf):
    zone = F.element_at(F.array(*map(F.lit, ZONES)), (F.col("n_nationkey") % len(ZONES) + 1).cast("int"))
    return table(spark, sf, "nation").select("n_nationkey", geo.utc_offset_hours(zone).alias("offset_hours"))


VARIABLES = {"lat_center": "latitude", "lon_center": "longitude", "h_center": "water_depth", "vap_jurisdiction": "jurisdiction", "vap_grid_resolution": "grid_resolution", "zeta": None, "nv": None, "u": "u"}


@REG.add("export_names", f"SELECT n_nationkey, {[v or '' for v in VARIABLES.values()]}[n_nationkey % {len(VARIABLES)} + 1] AS name FROM nation")
def export_names(spark, sf):
    variable = F.element_at(F.array(*map(F.lit, VARIABLES)), (F.col("n_nationkey") % len(VARIABLES) + 1).cast("int"))
    return table(spark, sf, "nation").select("n_nationkey", F.coalesce(names.export_name(variable, F.lit(True)), F.lit("")).alias("name"))


@REG.add("until_gap", f"""WITH {POINTS_SQL}, s AS (SELECT nation, face_id, value, value - lag(value) OVER (PARTITION BY nation ORDER BY value) AS step FROM points),
    l AS (SELECT nation, avg(step) + 1.5::DOUBLE * stddev_pop(step) AS most FROM s GROUP BY nation),
    c AS (SELECT nation, min(value) AS cut FROM s JOIN l USING (nation) WHERE step > most GROUP BY nation)
    SELECT nation, face_id FROM s LEFT JOIN c USING (nation) WHERE cut IS NULL OR value < cut""")
def until_gap(spark, sf):
    return spatial.until_gap(points(spark, sf), ["nation"], "value", 1.5).select("nation", "face_id")


@REG.add("wkt_rings", """WITH r AS (SELECT n_name AS boundary, n_nationkey * 14 - 175 AS x, (n_nationkey * 7) % 140 - 70 AS y FROM nation)
    SELECT boundary, CAST(i AS INTEGER) AS place, CAST([x, x + 13, x + 6, x + 11, x - 1][i + 1] AS DOUBLE) AS lon, CAST([y, y + 2, y + 5, y + 17, y + 12][i + 1] AS DOUBLE) AS lat FROM r, (SELECT unnest(generate_series(0, 4)) AS i)""")
def wkt_rings(spark, sf):
    parsed = rings(spark, sf).select("boundary", names.parse_wkt_polygon(writers.wkt_polygon("ring")).alias("ring"))
    return parsed.select("boundary", F.posexplode("ring").alias("place", "p")).select("boundary", "place", "p.lon", "p.lat")


@REG.add("human_times", "SELECT o_orderkey, CASE WHEN o_orderkey < 60 THEN o_orderkey || '.0s' WHEN o_orderkey < 3600 THEN (o_orderkey // 60) || 'm ' || (o_orderkey % 60) || 's' ELSE (o_orderkey // 3600) || 'h ' || (o_orderkey // 60 % 60) || 'm' END AS took FROM orders")
def human_times(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", names.human_time("o_orderkey").alias("took"))


@REG.add("data_file_names", "SELECT o_orderkey, o_orderpriority || '.hindcast-1h.b1.' || strftime(o_orderdate, '%Y%m%d.%H%M%S') || '.v1.2.3.nc' AS file, o_orderpriority AS location, 'b1' AS level, strftime(o_orderdate, '%Y-%m-%d') AS day, '1.2.3' AS version FROM orders")
def data_file_names(spark, sf):
    named = table(spark, sf, "orders").select("o_orderkey", names.data_file_name("o_orderpriority", "hindcast", "b1", "o_orderdate", "1h", "1.2.3", "nc").alias("file"))
    f = named.withColumn("f", names.parse_data_file("file"))
    return f.select("o_orderkey", "file", "f.location", "f.level", F.col("f.date").cast("string").alias("day"), "f.version")


@REG.add("face_batch_names", "SELECT p_partkey, p_partkey AS batch, p_partkey * 5 AS first, p_partkey * 5 + 4 AS last FROM part")
def face_batch_names(spark, sf):
    k = F.col("p_partkey")
    file = F.concat(F.lit("x.batch_"), k, F.lit("_faces_"), k * 5, F.lit("_"), k * 5 + 4, F.lit(".nc"))
    return table(spark, sf, "part").select("p_partkey", names.parse_face_batch(file).alias("b")).select("p_partkey", "b.*")


STAMP_SQL = "(o_orderdate + INTERVAL 1 SECOND * (o_orderkey * 37 % 86400))"


@REG.add("file_name_forms", f"""SELECT o_orderkey, o_orderstatus || '.hindcast-mean-1h.b2.' || strftime({STAMP_SQL}, '%Y%m%d.%H%M%S') || '.v1.0.0.created=' || strftime(o_orderdate, '%Y%m%d_%H%MZ') || '.nc' AS data_file,
    o_orderstatus || '.hindcast.b4.' || strftime({STAMP_SQL}, '%Y%m%d') || '.speed.png' AS figure_file, o_orderstatus || '.hindcast-30m.00.' || strftime({STAMP_SQL}, '%Y%m%d') || '.raw.' || o_orderkey || '_0001.nc' AS original_file, o_orderstatus || '.hindcast.b3' AS static_file FROM orders""")
def file_name_forms(spark, sf):
    stamp = F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_orderkey") * 37 % 86400)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        names.level_file_name("o_orderstatus", "hindcast", "b2", stamp, "mean", "1h", "1.0.0", "o_orderdate").alias("data_file"),
        names.figure_file_name("o_orderstatus", "hindcast", "b4", stamp, F.lit("speed")).alias("figure_file"),
        names.original_file_name("o_orderstatus", "hindcast", stamp, F.concat(F.col("o_orderkey").cast("string"), F.lit("_0001.nc")), temporal="30m").alias("original_file"),
        names.level_file_name("o_orderstatus", "hindcast", "b3", None, ext=None).alias("static_file"),
    )


@REG.add("repaired_names", f"""WITH n AS (SELECT o_orderkey, {STAMP_SQL} AS t, 'AK.tidal.b1_vap.' || strftime(o_orderdate, '%Y%m%d') || '.' AS head, '.v1.0.' || o_orderkey % 3 || '.nc' AS tail FROM orders)
    SELECT o_orderkey, head || CASE WHEN o_orderkey % 3 = 1 THEN '00' ELSE '' END || strftime(t, '%H%M%S') || tail AS name FROM n""")
def repaired_names(spark, sf):
    """A third of the names with a date for the time of day, a third with eight digits that are none, a third right."""
    k, stamp = F.col("o_orderkey"), F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_orderkey") * 37 % 86400)
    clock = F.date_format(stamp, "HHmmss")
    second = F.when(k % 3 == 0, F.date_format(stamp, "yyyyMMdd")).when(k % 3 == 1, F.concat(F.lit("00"), clock)).otherwise(clock)
    name = F.concat(F.lit("AK.tidal.b1_vap."), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("."), second, F.lit(".v1.0."), (k % 3).cast("string"), F.lit(".nc"))
    return table(spark, sf, "orders").select("o_orderkey", names.repaired_file_name(name, stamp).alias("name"))
