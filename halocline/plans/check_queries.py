"""Data quality, profiles and attribute texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from halocline.functions import text
from halocline.operators import checks, profiles
from halocline.plans.tables import POINTS_SQL, SERIES_SQL, TOP_SQL, Registry, points, rounded, series, table, top_point

REG = Registry()


@REG.add("position_range_check", f"WITH {POINTS_SQL} SELECT face_id FROM points WHERE NOT (lat * 1.05 BETWEEN -90 AND 90 AND lon * 1.02 BETWEEN -180 AND 180)")
def position_range_check(spark, sf):
    p = points(spark, sf).withColumns({"lat": F.col("lat") * 1.05, "lon": F.col("lon") * 1.02})
    return checks.out_of_range(p, "lat", "lon").select("face_id")


@REG.add("coordinate_equality", "SELECT l_linenumber AS source, l_suppkey AS face_id FROM (SELECT l_linenumber, l_suppkey, max(l_quantity) AS q FROM lineitem GROUP BY ALL) a LEFT JOIN (SELECT l_suppkey AS k, max(l_quantity) AS q0 FROM lineitem WHERE l_linenumber = 1 GROUP BY ALL) b ON k = l_suppkey WHERE q IS DISTINCT FROM q0 OR k IS NULL")
def coordinate_equality(spark, sf):
    t = table(spark, sf, "lineitem").groupBy(F.col("l_linenumber").alias("source"), F.col("l_suppkey").alias("face_id")).agg(F.max("l_quantity").alias("q"))
    return checks.differs_from_first(t, ["face_id"], "source", ["q"])


@REG.add("constant_check", "SELECT l_orderkey AS face_id FROM lineitem GROUP BY l_orderkey HAVING min(l_returnflag) <> max(l_returnflag)")
def constant_check(spark, sf):
    return checks.not_constant(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("face_id"), "l_returnflag"), ["face_id"], ["l_returnflag"])


@REG.add("attribute_changes", "SELECT event_id, 'k' AS attribute, json_extract_string(props, '$.k') AS old, (CAST(json_extract_string(props, '$.k') AS BIGINT) % 50)::VARCHAR AS new FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50")
def attribute_changes(spark, sf):
    k = F.get_json_object("props", "$.k")
    before = table(spark, sf, "events").select("event_id", F.create_map(F.lit("k"), k, F.lit("history"), F.lit("a"), F.lit("geospatial_lat_max"), F.lit("1.00001")).alias("attrs"))
    after = table(spark, sf, "events").select("event_id", F.create_map(F.lit("k"), (k.cast("long") % 50).cast("string"), F.lit("history"), F.lit("b"), F.lit("geospatial_lat_max"), F.lit("1.00002")).alias("attrs"))
    return checks.attribute_changes(before, after, ["event_id"], "attrs", ["history"])


@REG.add("missing_required", "SELECT p_partkey AS face_id FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50)")
def missing_required(spark, sf):
    required = table(spark, sf, "part").select(F.col("p_partkey").alias("face_id"))
    found = table(spark, sf, "lineitem").where("l_quantity >= 50").select(F.col("l_partkey").alias("face_id"))
    return checks.missing_required(found, required, ["face_id"])


@REG.add("null_columns", "SELECT 'b' AS \"column\", count(*) AS n_null FROM orders WHERE o_orderstatus = 'F'")
def null_columns(spark, sf):
    t = table(spark, sf, "orders").select(F.col("o_orderkey").alias("a"), F.when(F.col("o_orderstatus") == "F", float("nan")).when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("b"))
    return checks.null_columns(t, ["a", "b"])


@REG.add("vertical_extent", "SELECT max(p_retailprice) AS vertical_max, -max(p_size) AS vertical_min FROM part")
def vertical_extent(spark, sf):
    return checks.vertical_extent(table(spark, sf, "part"), "p_retailprice", "p_size")


@REG.add("point_series", f"WITH {SERIES_SQL}, {POINTS_SQL} SELECT event_id, time, zeta FROM series WHERE face_id = (SELECT face_id FROM points WHERE face_id IN (SELECT face_id FROM series) ORDER BY sqrt(pow(lat + 20, 2) + pow(lon - 10, 2)), face_id LIMIT 1) AND time BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-20'")
def point_series(spark, sf):
    return profiles.point_series(points(spark, sf).join(series(spark, sf).select("face_id").distinct(), "face_id", "left_semi"), series(spark, sf), -20.0, 10.0, "2024-01-03 00:00:00", "2024-01-20 00:00:00").select("event_id", "time", "zeta")


@REG.add("rank_within", f"WITH {POINTS_SQL} SELECT * FROM (SELECT nation, face_id, value, CAST(row_number() OVER (PARTITION BY nation ORDER BY value DESC, face_id) AS INTEGER) AS rank FROM points) WHERE rank <= 3")
def rank_within(spark, sf):
    return profiles.rank_within(points(spark, sf).select("nation", "face_id", "value"), ["nation"], "value", "face_id", 3)


@REG.add("vertical_rows", "SELECT vec_id AS face_id, CAST(i - 1 AS INTEGER) AS sigma_layer, CAST(embedding[i] AS DOUBLE) AS depth, CAST(embedding[i + 10] AS DOUBLE) AS value FROM embeddings, (SELECT unnest(generate_series(1, 10)) AS i)")
def vertical_rows(spark, sf):
    double = lambda a, n: F.transform(F.slice("embedding", a, n), lambda x: x.cast("double"))
    t = table(spark, sf, "embeddings").select(F.col("vec_id").alias("face_id"), double(1, 10).alias("d"), double(11, 10).alias("v"))
    return profiles.vertical_rows(t, ["face_id"], "d", "v")


PROFILE_SQL = f"""WITH {POINTS_SQL}, {TOP_SQL}, w AS (SELECT i AS position, lat0, lon0, lat0 + 1 + i / 199::DOUBLE * 30 AS lat, lon0 + 1 + i / 199::DOUBLE * 60 AS lon FROM generate_series(0, 199) AS g(i), top),
    t AS (SELECT face_id, lat AS y0, lon AS x0, value AS z0, lat + 8 AS y1, lon AS x1, value + 1 AS z1, lat AS y2, lon + 8 AS x2, value + 2 AS z2 FROM points),
    b AS (SELECT w.position, t.*, ((y1 - y2) * (w.lon - x2) + (x2 - x1) * (w.lat - y2)) / ((y1 - y2) * (x0 - x2) + (x2 - x1) * (y0 - y2)) AS p, ((y2 - y0) * (w.lon - x2) + (x0 - x2) * (w.lat - y2)) / ((y1 - y2) * (x0 - x2) + (x2 - x1) * (y0 - y2)) AS q
        FROM w JOIN t ON w.lat BETWEEN y0 AND y1 AND w.lon BETWEEN x0 AND x2),
    h AS (SELECT position, min(face_id) AS face_id, arg_min(p * z0 + q * z1 + (1 - p - q) * z2, face_id) AS value FROM b WHERE p >= -1e-10 AND q >= -1e-10 AND 1 - p - q >= -1e-10 GROUP BY position)
    SELECT position, round(lat, 6) + 0.0 AS lat, round(lon, 6) + 0.0 AS lon, round(2 * 6371.0 * asin(least(1, sqrt(pow(sin(radians(lat - lat0 - 1) / 2), 2) + cos(radians(lat0 + 1)) * cos(radians(lat)) * pow(sin(radians(lon - lon0 - 1) / 2), 2)))), 6) + 0.0 AS distance_km,
           face_id, round(value, 6) + 0.0 AS value FROM w LEFT JOIN h USING (position)"""


@REG.add("elevation_profile", PROFILE_SQL)
def elevation_profile(spark, sf):
    lat, lon = top_point(spark, sf)
    p = points(spark, sf).withColumns({"la2": F.col("lat") + 8, "lo2": F.col("lon"), "la3": F.col("lat"), "lo3": F.col("lon") + 8, "v2": F.col("value") + 1, "v3": F.col("value") + 2})
    return rounded(profiles.elevation_profile(p, (lat + 1, lon + 1), (lat + 31, lon + 61), 200, "value", [("lat", "lon", "value"), ("la2", "lo2", "v2"), ("la3", "lo3", "v3")]), "lat", "lon", "distance_km", "value")


@REG.add("history_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT00:00:00') AS iso FROM orders")
def history_date(spark, sf):
    d = F.col("o_orderdate")
    styled = F.when(F.col("o_orderkey") % 2 == 0, F.date_format(d, "yyyy/M/d")).otherwise(F.date_format(d, "d/M/yyyy"))
    return table(spark, sf, "orders").select("o_orderkey", text.history_date(F.concat(F.lit("model started at: "), styled, F.lit(" ok"))).alias("iso"))


@REG.add("forcing_sentence", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'included: tide, wind' WHEN o_orderstatus = 'O' THEN 'included: tide; excluded: wind' ELSE 'excluded: tide, wind' END AS forcing FROM orders")
def forcing_sentence(spark, sf):
    s = F.col("o_orderstatus")
    flag = lambda on: F.when(on, "T").otherwise("F")
    flags = F.concat(F.lit("tide = "), flag(s != "P"), F.lit("\nnote\nwind = "), flag(s == "F"))
    return table(spark, sf, "orders").select("o_orderkey", text.forcing_sentence(flags).alias("forcing"))


@REG.add("references", "SELECT s_suppkey, s_name || ' (2020). Work ' || s_suppkey || '. https://doi.org/10.1/' || s_suppkey AS entry, '(' || s_name || ', 2020)' AS citation FROM supplier")
def references(spark, sf):
    key = F.col("s_suppkey")
    return table(spark, sf, "supplier").select("s_suppkey", text.reference("s_name", F.lit(2020), F.concat(F.lit("Work "), key), F.lit(None).cast("string"), F.concat(F.lit("10.1/"), key)).alias("entry"), text.citation("s_name", F.lit(2020)).alias("citation"))


@REG.add("decode_time", "SELECT o_orderkey, TIMESTAMP '2000-01-01' + to_hours(o_orderkey) AS t FROM orders")
def decode_time(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", text.decode_time("o_orderkey", F.lit("hours since 2000-01-01")).cast("timestamp_ntz").alias("t"))
