"""Velocities, depths and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from halocline.functions import depth, flow
from halocline.operators import derive, summary, timeline
from halocline.plans.tables import LAYERS_SQL, POINTS_SQL, SERIES_SQL, VELOCITY_SQL, Registry, layers, points, rounded, series, table, velocity

REG = Registry()


@REG.add("speed_direction_power", f"WITH {VELOCITY_SQL} SELECT face_id, row_id, sigma_layer, round(speed, 6) AS speed, round(to_direction, 6) + 0.0 AS to_direction, round(power_density, 2) AS power_density FROM flow")
def speed_direction_power(spark, sf):
    return derive.add_flow(velocity(spark, sf)).select("face_id", "row_id", "sigma_layer", F.round("speed", 6).alias("speed"), (F.round("to_direction", 6) + 0.0).alias("to_direction"), F.round("power_density", 2).alias("power_density"))


@REG.add("from_direction", f"WITH {VELOCITY_SQL} SELECT row_id, sigma_layer, round((to_direction + 180) % 360, 6) + 0.0 AS from_direction FROM flow")
def from_direction(spark, sf):
    return derive.add_flow(velocity(spark, sf)).select("row_id", "sigma_layer", (F.round(flow.from_direction("to_direction"), 6) + 0.0).alias("from_direction"))


@REG.add("yearly_face_stats", f"""WITH {VELOCITY_SQL}
    SELECT face_id, round(avg(speed), 6) AS speed_mean, round(avg(to_direction), 6) AS to_direction_mean, round(max(speed), 6) AS speed_max,
           round(quantile_cont(speed, 0.95), 6) AS speed_p95, round(quantile_cont(speed, 0.99), 6) AS speed_p99 FROM flow GROUP BY face_id""")
def yearly_face_stats(spark, sf):
    out = summary.statistics(derive.add_flow(velocity(spark, sf)), ["face_id"], ["speed", "to_direction"], ["speed"])
    return rounded(out, *out.columns[1:])


@REG.add("monthly_face_stats", f"""WITH {VELOCITY_SQL}
    SELECT face_id, year(time) AS year, month(time) AS month, round(avg(speed), 6) AS speed_mean, round(max(speed), 6) AS speed_max,
           round(quantile_cont(speed, 0.95), 6) AS speed_p95 FROM flow GROUP BY ALL""")
def monthly_face_stats(spark, sf):
    df = derive.add_flow(velocity(spark, sf)).withColumn("year", F.year("time").cast("long")).withColumn("month", F.month("time").cast("long"))
    out = summary.statistics(df, ["face_id", "year", "month"], ["speed"], ["speed"], (0.95,))
    return rounded(out, *out.columns[3:])


@REG.add("p95_of_bucket_max", f"""WITH {VELOCITY_SQL}, peaks AS (SELECT face_id, date_trunc('month', time) AS b, max(speed) AS m FROM flow GROUP BY ALL)
    SELECT face_id, round(max(m), 6) AS speed_max, round(quantile_cont(m, 0.95), 6) AS speed_p95, round(quantile_cont(m, 0.99), 6) AS speed_p99 FROM peaks GROUP BY face_id""")
def p95_of_bucket_max(spark, sf):
    out = summary.percentile_of_bucket_maxima(derive.add_flow(velocity(spark, sf)), ["face_id"], timeline.month_bucket(), "speed")
    return rounded(out, *out.columns[1:])


@REG.add("surface_layer_stats", f"""WITH {VELOCITY_SQL}
    SELECT face_id, round(avg(speed), 6) AS surface_speed_mean, round(max(speed), 6) AS surface_speed_max, round(quantile_cont(speed, 0.95), 6) AS surface_speed_p95,
           round(quantile_cont(speed, 0.99), 6) AS surface_speed_p99 FROM flow WHERE sigma_layer = 0 GROUP BY face_id""")
def surface_layer_stats(spark, sf):
    out = summary.surface_layer(derive.add_flow(velocity(spark, sf)), ["face_id"], "speed")
    return rounded(out, *out.columns[1:])


@REG.add("depth_stats", f"""WITH {LAYERS_SQL}
    SELECT face_id, round(avg(value), 6) + 0.0 AS value_mean, round(median(value), 6) + 0.0 AS value_median, round(max(value), 6) + 0.0 AS value_max,
           round(quantile_cont(value, 0.95), 6) + 0.0 AS value_p95 FROM layers GROUP BY face_id""")
def depth_stats(spark, sf):
    out = derive.depth_statistics(layers(spark, sf), ["face_id"], "value")
    return rounded(out, *out.columns[1:])


@REG.add("layer_array_stats", f"WITH {LAYERS_SQL} SELECT face_id, round(avg(value), 6) + 0.0 AS layer_mean, round(max(value), 6) + 0.0 AS layer_max FROM layers GROUP BY face_id")
def layer_array_stats(spark, sf):
    stats = derive.layer_array_statistics(F.slice("embedding", 1, 10))
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("face_id"), *[(F.round(c, 6) + 0.0).alias(f"layer_{n}") for n, c in stats.items()])


@REG.add("depth_average", f"""WITH {VELOCITY_SQL} SELECT row_id, round(avg(u), 10) + 0.0 AS u_depth_avg, round(avg(v), 10) + 0.0 AS v_depth_avg,
    round(avg(to_direction), 10) + 0.0 AS to_direction_depth_avg FROM flow GROUP BY row_id""")
def depth_average(spark, sf):
    out = summary.depth_average(derive.add_flow(velocity(spark, sf)), ["row_id"], ["u", "v", "to_direction"])
    return rounded(out, *out.columns[1:], digits=10)


@REG.add("face_center_mean", """
    WITH face_node AS (SELECT l_orderkey AS face_id, l_linenumber AS corner, l_partkey AS node_id FROM lineitem WHERE l_linenumber <= 3)
    SELECT face_id, CASE WHEN count(*) = 3 THEN round(avg(p_retailprice), 6) END AS zeta_center
    FROM face_node JOIN part ON node_id = p_partkey GROUP BY face_id""")
def face_center_mean(spark, sf):
    face_node = table(spark, sf, "lineitem").where("l_linenumber <= 3").select(F.col("l_orderkey").alias("face_id"), F.col("l_linenumber").alias("corner"), F.col("l_partkey").alias("node_id"))
    node = table(spark, sf, "part").select(F.col("p_partkey").alias("node_id"), F.col("p_retailprice").alias("zeta"))
    return rounded(derive.gather_nodes(face_node, node, "zeta", ["face_id"]), "zeta_center")


@REG.add("sigma_depth", f"""
    WITH {SERIES_SQL}, face AS (SELECT s_suppkey AS face_id, abs(s_acctbal) / 100 AS h, s_nationkey / 10.0 AS off FROM supplier)
    SELECT s.face_id, event_id, i AS sigma_layer, round(h + zeta, 6) AS sea_floor_depth, round(zeta - off, 6) + 0.0 AS surface_elevation,
           round(-(h + zeta) * (-0.05 - 0.1 * i), 6) AS sigma_depth
    FROM series s JOIN face USING (face_id), (SELECT unnest(generate_series(0, 9)) AS i)""")
def sigma_depth(spark, sf):
    face = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("face_id"), (F.abs("s_acctbal") / 100).alias("h_center"), (F.col("s_nationkey") / 10.0).alias("mean_navd88_offset"))
    fact = series(spark, sf).withColumnRenamed("zeta", "zeta_center").join(face.select("face_id"), "face_id", "left_semi")
    out = derive.add_depths(fact, face, ["face_id"]).select("face_id", "event_id", "sea_floor_depth", "surface_elevation", F.posexplode("sigma_depths").alias("sigma_layer", "sigma_depth"))
    return rounded(out.withColumn("sigma_layer", F.col("sigma_layer").cast("long")), "sea_floor_depth", "surface_elevation", "sigma_depth")


@REG.add("column_height", "SELECT o_custkey AS face_id, round(min(o_totalprice), 6) AS water_column_height_min, round(max(o_totalprice), 6) AS water_column_height_max FROM orders GROUP BY 1")
def column_height(spark, sf):
    out = summary.column_height(table(spark, sf, "orders").select(F.col("o_custkey").alias("face_id"), "o_totalprice"), ["face_id"], "o_totalprice")
    return rounded(out, *out.columns[1:])


@REG.add("datum_offset", f"WITH {SERIES_SQL} SELECT face_id, round(avg(zeta), 6) AS mean_navd88_offset FROM series GROUP BY face_id")
def datum_offset(spark, sf):
    return rounded(derive.datum_offset(series(spark, sf).withColumnRenamed("zeta", "zeta_center"), ["face_id"]), "mean_navd88_offset")


@REG.add("direction_mode", f"""WITH {VELOCITY_SQL},
    bins AS (SELECT face_id, CAST(least(floor(to_direction / 10), 35) AS INTEGER) AS b, count(*) AS n, coalesce(avg(speed) FILTER (to_direction < 360), 0) AS s
             FROM flow WHERE to_direction IS NOT NULL GROUP BY ALL),
    p AS (SELECT face_id, arg_max(b, (n, -b)) AS pb FROM bins GROUP BY face_id),
    f AS (SELECT *, least(abs(b - pb) * 10, 360 - abs(b - pb) * 10) > 90 AS far FROM bins JOIN p USING (face_id))
    SELECT face_id, max(pb) * 10.0::DOUBLE AS primary_direction, round(max(s) FILTER (b = pb), 6) AS primary_speed,
           CAST(arg_max(b, (n, -b)) FILTER (far) * 10.0 AS DOUBLE) AS secondary_direction, round(arg_max(s, (n, -b)) FILTER (far), 6) AS secondary_speed
    FROM f GROUP BY face_id""")
def direction_mode(spark, sf):
    out = summary.modal_directions(derive.add_flow(velocity(spark, sf)), ["face_id"], "to_direction", "speed", width=10.0)
    return rounded(out, "primary_speed", "secondary_speed")


FLOOD_SQL = f"""WITH {VELOCITY_SQL},
    e AS (SELECT *, u + v AS z, row_number() OVER w AS k, lag(u + v) OVER w AS a, lead(u + v) OVER w AS b FROM flow WINDOW w AS (PARTITION BY face_id ORDER BY time, row_id, sigma_layer)),
    g AS (SELECT *, CASE WHEN a IS NULL THEN b - z WHEN b IS NULL THEN z - a ELSE (b - a) / 2 END AS slope FROM e),
    p AS (SELECT *, CASE WHEN slope > 0 THEN 'flood' WHEN slope < 0 THEN 'ebb' END AS phase FROM g),
    bins AS (SELECT face_id, phase, CAST(least(floor(to_direction / 2), 179) AS INTEGER) AS b, count(to_direction) AS n, avg(speed) FILTER (to_direction < 360) AS s,
                    count(*) FILTER (speed >= 0.5) * 0.5 AS h FROM p WHERE phase IS NOT NULL GROUP BY ALL),
    r AS (SELECT face_id, arg_max(b, (n, -b)) FILTER (phase = 'flood' AND b IS NOT NULL) * 2.0 AS fd, arg_max(s, (n, -b)) FILTER (phase = 'flood' AND b IS NOT NULL) AS fs, sum(h) FILTER (phase = 'flood') AS fh,
                 arg_max(b, (n, -b)) FILTER (phase = 'ebb' AND b IS NOT NULL) * 2.0 AS ed, arg_max(s, (n, -b)) FILTER (phase = 'ebb' AND b IS NOT NULL) AS es, sum(h) FILTER (phase = 'ebb') AS eh FROM bins GROUP BY face_id)
    SELECT face_id, CAST(coalesce(fd, 0) AS DOUBLE) AS flood_direction, round(coalesce(fs, 0), 6) AS flood_mean_speed, CAST(coalesce(fh, 0) AS DOUBLE) AS flood_hours,
           CAST(coalesce(ed, 0) AS DOUBLE) AS ebb_direction, round(coalesce(es, 0), 6) AS ebb_mean_speed, CAST(coalesce(eh, 0) AS DOUBLE) AS ebb_hours
    FROM (SELECT DISTINCT face_id FROM velocity) LEFT JOIN r USING (face_id)"""


@REG.add("flood_ebb", FLOOD_SQL)
def flood_ebb(spark, sf):
    df = derive.add_flow(velocity(spark, sf)).withColumn("z", F.col("u") + F.col("v"))
    out = summary.flood_ebb(df, ["face_id"], ["time", "row_id", "sigma_layer"], "to_direction", "speed", "z")
    return rounded(out, "flood_mean_speed", "ebb_mean_speed")


@REG.add("max_to_mean_ratio", f"""WITH {VELOCITY_SQL} SELECT face_id, round(quantile_cont(speed, 0.95) / nullif(avg(speed), 0), 6) AS ratio FROM flow GROUP BY face_id""")
def max_to_mean_ratio(spark, sf):
    out = summary.statistics(derive.add_flow(velocity(spark, sf)), ["face_id"], ["speed"], ["speed"], (0.95,))
    return out.select("face_id", F.round(flow.max_to_mean_ratio("speed_p95", "speed_mean"), 6).alias("ratio"))


@REG.add("triangle_area", f"""WITH {POINTS_SQL},
    t AS (SELECT face_id, radians(lat / 2) AS a1, radians(lon) AS o1, radians(lat / 2 + 0.1) AS a2, radians(lon + 0.1) AS o2, radians(lat / 2) AS a3, radians(lon + 0.2) AS o3 FROM points),
    x AS (SELECT face_id, cos(a1)*cos(o1) AS ax, cos(a1)*sin(o1) AS ay, sin(a1) AS az, cos(a2)*cos(o2) AS bx, cos(a2)*sin(o2) AS b_y, sin(a2) AS bz, cos(a3)*cos(o3) AS cx, cos(a3)*sin(o3) AS cy, sin(a3) AS cz FROM t),
    d AS (SELECT face_id, bx-ax AS px, b_y-ay AS py, bz-az AS pz, cx-ax AS qx, cy-ay AS qy, cz-az AS qz FROM x)
    SELECT face_id, round(0.5 * 6371000.0 * 6371000.0 * sqrt((py*qz-pz*qy)**2 + (pz*qx-px*qz)**2 + (px*qy-py*qx)**2), 0) AS area_m2 FROM d""")
def triangle_area(spark, sf):
    p = points(spark, sf).withColumn("la", F.col("lat") / 2)
    area = depth.triangle_area([("la", "lon"), (F.col("la") + 0.1, F.col("lon") + 0.1), ("la", F.col("lon") + 0.2)])
    return p.select("face_id", F.round(area, 0).alias("area_m2"))


@REG.add("element_volume", """SELECT p_partkey AS face_id, round(p_retailprice * p_size / 10, 6) AS volume_m3, round(p_retailprice * (p_size + 2) / 10, 6) AS volume_twice_m3 FROM part""")
def element_volume(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("face_id"), F.round(depth.element_volume("p_retailprice", "p_size", F.lit(2)), 6).alias("volume_m3"), F.round(depth.element_volume("p_retailprice", "p_size", F.lit(2), add_elevation=True), 6).alias("volume_twice_m3"))


@REG.add("sigma_table", f"WITH {LAYERS_SQL} SELECT sigma_layer, round(-0.05 - 0.1 * sigma_layer, 6) AS sigma, count(*) AS n_faces, round(avg(value), 9) + 0.0 AS mean_value FROM layers GROUP BY sigma_layer")
def sigma_table(spark, sf):
    """The table's layers where they lie, with the faces and the mean of each."""
    rows = layers(spark, sf).join(depth.sigma_table(spark), "sigma_layer").groupBy("sigma_layer", "sigma")
    return rounded(rounded(rows.agg(F.count("*").alias("n_faces"), F.avg("value").alias("mean_value")), "sigma"), "mean_value", digits=9)


def flagship(spark, sf):
    """Read, derive, depth statistics, then a year's means, maxima and percentiles per face."""
    per_row = derive.depth_statistics(derive.add_flow(velocity(spark, sf)), ["face_id", "row_id"], "speed")
    out = summary.statistics(per_row, ["face_id"], ["speed_mean"], ["speed_max"])
    return rounded(out, *out.columns[1:]).orderBy("face_id")


REG.add("flagship_year", f"""WITH {VELOCITY_SQL}, r AS (SELECT face_id, row_id, avg(speed) AS m, max(speed) AS x FROM flow GROUP BY ALL)
    SELECT face_id, round(avg(m), 6) AS speed_mean_mean, round(max(x), 6) AS speed_max_max, round(quantile_cont(x, 0.95), 6) AS speed_max_p95, round(quantile_cont(x, 0.99), 6) AS speed_max_p99
    FROM r GROUP BY face_id""")(flagship)
