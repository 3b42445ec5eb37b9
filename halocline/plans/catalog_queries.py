"""Manifests, standard names and units, file names, and extracted series."""

from __future__ import annotations

from pyspark.sql import functions as F

from halocline.operators import derive, spatial, standard, summary, timeline
from halocline.plans.flow_queries import FLOOD_SQL
from halocline.plans.space_queries import transect_start
from halocline.plans.tables import POINTS_SQL, SERIES_SQL, TOP_SQL, VELOCITY_SQL, Registry, points, rounded, series, table, velocity
from halocline.sources import manifest, readers

REG = Registry()
TEMPLATE = "{location}/{data_version}/{data_level}/lat_deg={lat_deg}/lon_deg={lon_deg}/lat_dec={lat_dec}/lon_dec={lon_dec}/{location}.face={face_id}.lat={lat}.lon={lon}-{temporal}.b4.{date}.{time}.parquet"
PLACE_SQL = f"""{POINTS_SQL}, place AS (SELECT face_id, location || '/1.' || length(location) || '.0/b1/lat_deg=' || CAST(trunc(lat) AS INTEGER) || '/lon_deg=' || CAST(trunc(lon) AS INTEGER)
    || '/lat_dec=' || printf('%02d', CAST(floor((abs(lat) - floor(abs(lat))) * 100) AS BIGINT)) || '/lon_dec=' || printf('%02d', CAST(floor((abs(lon) - floor(abs(lon))) * 100) AS BIGINT))
    || '/' || location || '.face=' || lpad(face_id::VARCHAR, 8, '0') || '.lat=' || printf('%.7f', lat) || '.lon=' || printf('%.7f', lon) || '-' || CASE WHEN location < 'F' THEN '1h' ELSE '30m' END || '.b4.20050101.000000.parquet' AS path
    FROM (SELECT face_id, location, CAST(printf('%.7f', lat) AS DOUBLE) AS lat, CAST(printf('%.7f', lon) AS DOUBLE) AS lon FROM points))"""


def text_points(spark, sf):
    return points(spark, sf).select("location", "face_id", F.format_string("%.7f", "lat").alias("lat"), F.format_string("%.7f", "lon").alias("lon"))


def paths(spark, sf):
    name = F.col("c_mktsegment")
    locations = table(spark, sf, "customer").select(name.alias("location"), F.concat(F.lit("1."), F.length(name), F.lit(".0")).alias("latest_version"), F.when(name < "F", "1h").otherwise("30m").alias("temporal"), F.lit("20050101").alias("date"), F.lit("000000").alias("time")).distinct()
    return manifest.point_paths(text_points(spark, sf), locations, TEMPLATE, "b1")


@REG.add("manifest_paths", f"WITH {PLACE_SQL} SELECT face_id, path FROM place")
def manifest_paths(spark, sf):
    return paths(spark, sf).select("face_id", "path")


@REG.add("manifest_full_paths", f"WITH {PLACE_SQL} SELECT face_id, CASE WHEN face_id % 3 = 0 THEN '/data/hindcast/' ELSE 's3://bucket/tidal/' END || path AS uri FROM place")
def manifest_full_paths(spark, sf):
    return paths(spark, sf).select("face_id", manifest.full_path("path", F.col("face_id") % 3 == 0, "s3://bucket/tidal/", "/data/hindcast").alias("uri"))


def part_versions(spark, sf):
    version = F.when(F.col("p_partkey") % 17 == 0, "latest").otherwise(F.concat_ws(".", F.col("p_size") % 3, F.col("p_size"), F.col("p_partkey") % 13))
    return table(spark, sf, "part").select(F.col("p_brand").alias("location"), F.col("p_type").alias("level"), version.alias("version"))


VERSIONS_SQL = """ver AS (SELECT p_brand AS location, p_type AS level, (p_size % 3) || '.' || p_size || '.' || (p_partkey % 13) AS version, (p_size % 3) * 1000000 + p_size * 1000 + p_partkey % 13 AS number FROM part WHERE p_partkey % 17 <> 0)"""


@REG.add("location_versions", f"WITH {VERSIONS_SQL} SELECT location, arg_max(version, number) AS latest_version, count(DISTINCT version) AS n_versions FROM ver GROUP BY location")
def location_versions(spark, sf):
    return manifest.location_versions(part_versions(spark, sf))


@REG.add("version_disagreements", f"WITH {VERSIONS_SQL} SELECT location, (SELECT count(DISTINCT p_type) FROM part WHERE p_brand = location) AS n_levels, arg_min(version, number) AS least, arg_max(version, number) AS greatest FROM ver GROUP BY location HAVING min(number) <> max(number)")
def version_disagreements(spark, sf):
    return manifest.version_disagreements(part_versions(spark, sf))


@REG.add("canonical_columns", "SELECT s_suppkey AS face, s_acctbal AS lat_center, s_nationkey AS lon_center FROM supplier")
def canonical_columns(spark, sf):
    raw = table(spark, sf, "supplier").withColumnsRenamed({"s_suppkey": "nele", "s_acctbal": "latc", "s_nationkey": "lonc", "s_name": "itime2"})
    return standard.declared(standard.canonical(raw), ["face", "lat_center", "lon_center"])


UNITS_SQL = """SELECT p_partkey AS dataset, CASE WHEN p_size % 7 = 0 THEN 'missing variable' WHEN p_size % 5 = 0 THEN 'h_center: units undefined' WHEN p_size % 3 = 0 THEN 'h_center: positive is not down'
    WHEN p_size % 11 = 0 THEN 'zeta_center: positive direction undefined' WHEN p_size % 2 = 0 THEN 'units differ' END AS problem FROM part WHERE p_size % 7 = 0 OR p_size % 5 = 0 OR p_size % 3 = 0 OR p_size % 11 = 0 OR p_size % 2 = 0"""


@REG.add("unit_checks", UNITS_SQL)
def unit_checks(spark, sf):
    n = F.col("p_size")
    h = F.struct(F.lit("h_center").alias("variable"), F.when(n % 5 != 0, F.lit("m")).alias("units"), F.when(n % 3 == 0, "up").otherwise("down").alias("positive"))
    zeta = F.struct(F.lit("zeta_center").alias("variable"), F.when(n % 2 == 0, "cm").otherwise("m").alias("units"), F.when(n % 11 != 0, F.lit("up")).alias("positive"))
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("dataset"), F.explode(F.when(n % 7 == 0, F.array(h)).otherwise(F.array(h, zeta))).alias("a"))
    return standard.unit_problems(rows.select("dataset", "a.*"), ["dataset"], ("h_center", "zeta_center"), ("down", "up"))


FILE_SQL = """CASE WHEN o_orderkey % 2 = 0 THEN printf('%03d', o_orderkey % 1000) || '.' ELSE '' END || 'AK_' || o_orderstatus || '.tidal' || CASE WHEN o_orderkey % 3 = 0 THEN '-mean-depth' ELSE '' END
    || CASE WHEN o_orderkey % 5 < 3 THEN '-30m' ELSE '' END || '.b4.' || CASE WHEN o_orderkey % 7 = 0 THEN '0.0' ELSE strftime(o_orderdate, '%Y%m%d') || '.000000' END || CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE '.nc' END"""


def file_names(spark, sf):
    k = F.col("o_orderkey")
    number = F.when(k % 2 == 0, F.format_string("%03d.", k % 1000)).otherwise("")
    date = F.when(k % 7 == 0, "0.0").otherwise(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".000000")))
    name = F.concat(number, F.lit("AK_"), "o_orderstatus", F.lit(".tidal"), F.when(k % 3 == 0, "-mean-depth").otherwise(""), F.when(k % 5 < 3, "-30m").otherwise(""), F.lit(".b4."), date, F.when(k % 11 == 0, "").otherwise(".nc"))
    return table(spark, sf, "orders").select("o_orderkey", name.alias("name"))


@REG.add("file_name_parts", f"""WITH f AS (SELECT o_orderkey, string_split({FILE_SQL}, '.') AS p FROM orders), s AS (SELECT o_orderkey, p, CASE WHEN regexp_matches(p[1], '^[0-9]+$') THEN 1 ELSE 0 END AS n FROM f),
    d AS (SELECT *, regexp_extract(p[n + 2], '-([0-9]+[hsmHSM]z?)$', 1) AS step FROM s), b AS (SELECT *, CASE WHEN step = '' THEN p[n + 2] ELSE p[n + 2][:-length(step) - 2] END AS base FROM d)
    SELECT o_orderkey, CASE WHEN n = 1 THEN p[1] END AS prefix, p[n + 1] AS location, string_split(base, '-')[1] AS dataset, CASE WHEN contains(base, '-') THEN base[strpos(base, '-') + 1:] END AS qualifier, nullif(step, '') AS temporal,
           p[n + 3] AS level, p[n + 4] AS date, p[n + 5] AS time, p[-1] AS ext FROM b WHERE len(p) >= 6""")
def file_name_parts(spark, sf):
    parts = file_names(spark, sf).select("o_orderkey", standard.data_name_parts("name").alias("f"))
    return parts.where("f is not null").select("o_orderkey", "f.*")


@REG.add("files_without_date", f"SELECT o_orderkey FROM orders WHERE contains({FILE_SQL}, '.b4.0.0.')")
def files_without_date(spark, sf):
    return file_names(spark, sf).where(standard.without_date("name")).select("o_orderkey")


@REG.add("column_statistics", """SELECT 'c_acctbal' AS "column", count(c_acctbal) AS n_values, count(*) - count(c_acctbal) AS n_null, round(min(c_acctbal), 6) AS min_value, round(max(c_acctbal), 6) AS max_value, round(avg(c_acctbal), 6) AS mean_value FROM customer
    UNION ALL SELECT 'n', count(n), count(*) - count(n), min(n), max(n), round(avg(n), 6) FROM (SELECT CASE WHEN c_nationkey > 3 THEN c_nationkey END::DOUBLE AS n FROM customer)""")
def column_statistics(spark, sf):
    t = table(spark, sf, "customer").withColumn("n", F.when(F.col("c_nationkey") > 3, F.col("c_nationkey")))
    return rounded(standard.column_statistics(t, ["c_acctbal", "n"]), "min_value", "max_value", "mean_value")


@REG.add("percentile_table", f"""WITH {POINTS_SQL} SELECT nation, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99,
    round(quantile_cont(value, 0.999), 6) AS p99_9, round(count(*) FILTER (value <= 8000) * 100.0::DOUBLE / count(value), 6) AS retention_pct, CAST(least(60, floor(sqrt(count(value)))) AS INTEGER) AS n_bins FROM points GROUP BY nation""")
def percentile_table(spark, sf):
    return rounded(standard.percentile_table(points(spark, sf), ["nation"], "value", 8000.0), "p50", "p90", "p95", "p99", "p99_9", "retention_pct")


@REG.add("directory_sizes", r"""WITH f AS (SELECT string_split(regexp_extract(url, '://([^?#]*)', 1), '/') AS p, length(html) AS n FROM pages) SELECT array_to_string(p[1:least(2, len(p) - 1)], '/') AS directory, count(*) AS n_files, CAST(sum(n) AS BIGINT) AS total_bytes FROM f GROUP BY 1""")
def directory_sizes(spark, sf):
    files = table(spark, sf, "pages").select(F.regexp_extract("url", r"://([^?#]*)", 1).alias("path"), F.length("html").cast("long").alias("length"))
    return standard.directory_sizes(files, 2)


NEAR_SQL = f"""{SERIES_SQL}, {POINTS_SQL}, near AS (SELECT face_id, row_number() OVER (ORDER BY sqrt(pow(lat + 20, 2) + pow(lon - 10, 2)), face_id) AS r FROM points WHERE face_id IN (SELECT face_id FROM series) QUALIFY r <= 3)"""


@REG.add("nearest_series", f"WITH {NEAR_SQL} SELECT date_trunc('hour', time) AS time, max(zeta) FILTER (r = 1) AS zeta_1, max(zeta) FILTER (r = 2) AS zeta_2, max(zeta) FILTER (r = 3) AS zeta_3 FROM series JOIN near USING (face_id) GROUP BY 1")
def nearest_series(spark, sf):
    s = series(spark, sf).withColumn("time", F.date_trunc("hour", "time"))
    with_series = points(spark, sf).join(s.select("face_id").distinct(), "face_id", "left_semi")
    return standard.nearest_series(with_series, s, -20.0, 10.0, 3, "zeta")


@REG.add("surface_bucket_percentiles", f"""WITH {VELOCITY_SQL}, peaks AS (SELECT face_id, date_trunc('month', time) AS b, max(speed) AS m FROM flow WHERE sigma_layer = 0 GROUP BY ALL)
    SELECT face_id, round(max(m), 6) AS speed_max, round(quantile_cont(m, 0.95), 6) AS speed_p95, round(quantile_cont(m, 0.99), 6) AS speed_p99 FROM peaks GROUP BY face_id""")
def surface_bucket_percentiles(spark, sf):
    top = derive.add_flow(velocity(spark, sf)).where("sigma_layer = 0")  # the surface layer is the feature
    out = summary.percentile_of_bucket_maxima(top, ["face_id"], timeline.month_bucket(), "speed")
    return rounded(out, *out.columns[1:])


LAYER_SQL = (
    FLOOD_SQL.replace("PARTITION BY face_id ORDER BY time, row_id, sigma_layer", "PARTITION BY face_id, sigma_layer ORDER BY time, row_id")
    .replace("SELECT face_id, ", "SELECT face_id, sigma_layer, ")
    .replace("FROM bins GROUP BY face_id)", "FROM bins GROUP BY face_id, sigma_layer)")
    .replace("DISTINCT face_id FROM velocity) LEFT JOIN r USING (face_id)", "DISTINCT face_id, sigma_layer FROM velocity) LEFT JOIN r USING (face_id, sigma_layer)")
)


@REG.add("phase_depth_average", f"SELECT face_id, {', '.join(f'round(avg({c}), 6) AS {c}_depth_avg' for c in ('flood_direction', 'flood_mean_speed', 'ebb_direction', 'ebb_mean_speed'))} FROM ({LAYER_SQL}) GROUP BY face_id")
def phase_depth_average(spark, sf):
    df = derive.add_flow(velocity(spark, sf)).withColumn("z", F.col("u") + F.col("v"))
    phases = rounded(summary.flood_ebb(df, ["face_id", "sigma_layer"], ["time", "row_id"], "to_direction", "speed", "z"), "flood_mean_speed", "ebb_mean_speed")
    out = summary.depth_average(phases, ["face_id"], ["flood_direction", "flood_mean_speed", "ebb_direction", "ebb_mean_speed"])
    return rounded(out, *out.columns[1:])


@REG.add("declared_limits", f"WITH {POINTS_SQL} SELECT face_id FROM points WHERE NOT (lat BETWEEN -60 AND 70) OR NOT (value BETWEEN 0 AND 9000)")
def declared_limits(spark, sf):
    return standard.out_of_declared(points(spark, sf), {"lat": (-60.0, 70.0), "value": (0.0, 9000.0)}).select("face_id")


@REG.add("fact_sizes", f"WITH {SERIES_SQL} SELECT count(DISTINCT face_id) AS n_faces, count(DISTINCT time) AS n_times, count(*) AS n_rows FROM series")
def fact_sizes(spark, sf):
    return readers.fact_sizes(series(spark, sf))


@REG.add("transect_both_ways", f"""WITH {POINTS_SQL}, {TOP_SQL}, o AS (SELECT lat0 + 0.25::DOUBLE AS oy, lon0 + 0.4::DOUBLE AS ox FROM top), t AS (SELECT face_id, (lat - oy) * 111 AS y, (lon - ox) * 111 * cos(radians(oy)) AS x, 55.5::DOUBLE * cos(radians(oy)) AS half FROM points, o),
    c AS (SELECT face_id, [y, y + 111, y] AS ys, [x, x + half, x + 2 * half] AS xs FROM t),
    s AS (SELECT face_id, list_transform([1, 2, 3], lambda i: xs[i] * cos(radians(60)) - ys[i] * sin(radians(60))) AS side, list_transform([1, 2, 3], lambda i: ys[i] * cos(radians(60)) + xs[i] * sin(radians(60))) AS along FROM c)
    SELECT face_id, round(list_sum(along) / 3, 6) + 0.0 AS distance_km FROM s WHERE list_min(side) <= 0 AND list_max(side) >= 0 AND list_max(along) >= -3000 AND list_min(along) <= 5000""")
def transect_both_ways(spark, sf):
    p = points(spark, sf).withColumns({"la2": F.col("lat") + 1, "lo2": F.col("lon") + 0.5, "lo3": F.col("lon") + 1})
    cut = spatial.transect(p, transect_start(spark, sf), 60.0, 5000.0, [("lat", "lon"), ("la2", "lo2"), ("lat", "lo3")], back_km=3000.0)
    return rounded(cut.select("face_id", "distance_km"), "distance_km")


@REG.add("hotspot_neighbourhoods", f"""WITH {POINTS_SQL}, spots AS (SELECT n_nationkey + 1 AS rank, n_nationkey * 6 - 75 AS y, n_nationkey * 13 - 155 AS x FROM nation)
    SELECT CAST(rank AS INTEGER) AS rank, count(*) AS n_faces, round(avg(value), 6) AS mean_value, max(value) AS max_value, round(min(lat), 6) AS lat_min, round(max(lat), 6) AS lat_max, round(min(lon), 6) AS lon_min, round(max(lon), 6) AS lon_max
    FROM points, spots WHERE abs(lat - y) <= 2000000 / 2 / 111000.0::DOUBLE AND abs(lon - x) * cos(radians(y)) <= 2000000 / 2 / 111000.0::DOUBLE GROUP BY rank""")
def hotspot_neighbourhoods(spark, sf):
    key = F.col("n_nationkey")
    spots = table(spark, sf, "nation").select((key + 1).cast("int").alias("rank"), (key * 6 - 75).cast("double").alias("lat"), (key * 13 - 155).cast("double").alias("lon"))
    out = spatial.neighbourhoods(points(spark, sf), spots, "value", 2_000_000.0)
    return rounded(out, "mean_value", "lat_min", "lat_max", "lon_min", "lon_max")


@REG.add("hotspot_reports", f"""WITH {POINTS_SQL}, spots AS (SELECT n_nationkey + 1 AS rank, n_nationkey * 6 - 75 AS y, n_nationkey * 13 - 155 AS x FROM nation),
    f AS (SELECT face_id, lat, lon, value, min(rank) AS rank FROM points, spots WHERE abs(lat - y) <= 4000000 / 2 / 111000.0::DOUBLE AND abs(lon - x) * cos(radians(y)) <= 4000000 / 2 / 111000.0::DOUBLE GROUP BY ALL)
    SELECT CAST(rank AS INTEGER) AS rank, count(*) AS n_faces, round(avg(value), 6) AS mean_value, max(value) AS max_value, round(min(lat), 6) AS lat_min, round(max(lat), 6) AS lat_max, round(min(lon), 6) AS lon_min, round(max(lon), 6) AS lon_max
    FROM f GROUP BY ROLLUP (rank)""")
def hotspot_reports(spark, sf):
    """Squares that overlap: each face counts once, and all together at the end."""
    key = F.col("n_nationkey")
    spots = table(spark, sf, "nation").select((key + 1).cast("int").alias("rank"), (key * 6 - 75).cast("double").alias("lat"), (key * 13 - 155).cast("double").alias("lon"))
    out = spatial.neighbourhoods(points(spark, sf), spots, "value", 4_000_000.0, exclusive=True)
    return rounded(out, "mean_value", "lat_min", "lat_max", "lon_min", "lon_max")
