"""Coast lines, boundaries and jurisdictions on the driver's tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from halocline.functions import geo
from halocline.operators import coast, spatial
from halocline.plans.tables import POINTS_SQL, Registry, points, rounded, table
from halocline.sources import writers

REG = Registry()

#: A coast line passes 2 to 3 km from each 13th point and goes on for some 300 km, over the date line too; a supplier each.
COAST = ((-2.0, 0.3), (-0.05, 0.02), (0.06, 0.03), (1.5, -0.9), (2.1, 1.2))
#: A bent boundary around each 13th point.
RING = ((-14.03, -6.07), (-2.01, -8.02), (9.05, -5.51), (3.07, 0.33), (11.01, 7.31), (-1.03, 4.17), (-12.71, 9.23), (-7.13, 1.19))

ANCHOR_SQL = "anchor AS (SELECT s_suppkey AS k, s_acctbal AS balance, ((s_suppkey * 13 * 37) % 18000) / 100.0 - 90 AS y, ((s_suppkey * 13 * 91) % 36000) / 100.0 - 180 AS x FROM supplier)"


def anchors(spark, sf):
    key = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(key.alias("k"), F.col("s_acctbal").alias("balance"), (((key * 13 * 37) % 18000) / 100.0 - 90).alias("y"), (((key * 13 * 91) % 36000) / 100.0 - 180).alias("x"))


def around(offsets, wrap: bool):
    """An array of (lon, lat) around an anchor; latitudes end at the poles."""
    lon = lambda dx: geo.normalize_longitude(F.col("x") + dx) if wrap else F.col("x") + dx
    return F.array(*[F.struct(lon(dx).alias("lon"), F.least(F.greatest(F.col("y") + dy, F.lit(-90.0)), F.lit(90.0)).alias("lat")) for dx, dy in offsets])


def vertices_sql(offsets) -> str:
    rows = ", ".join(f"({i}, {dx}::DOUBLE, {dy}::DOUBLE)" for i, (dx, dy) in enumerate(offsets))
    return f"(SELECT k, i, x + dx AS x, least(greatest(y + dy, -90), 90) AS y FROM anchor, (VALUES {rows}) AS o(i, dx, dy))"


# Longitudes go on over the date line here; points are held against all three copies of the globe.
SEGMENTS_SQL = f"""{ANCHOR_SQL}, vertex AS {vertices_sql(COAST)},
    seg AS (SELECT a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM vertex a JOIN vertex b ON a.k = b.k AND b.i = a.i + 1),
    m AS (SELECT face_id, lat, lon, x1 + turn - lon AS ax, y1 - lat AS ay, x2 - x1 AS dx, y2 - y1 AS dy FROM points, seg, (VALUES (-360), (0), (360)) AS t(turn)),
    q AS (SELECT face_id, lat, lon, ax, ay, dx, dy, coalesce(least(greatest(-(ax * dx + ay * dy) / nullif(dx * dx + dy * dy, 0), 0), 1), 0) AS f FROM m),
    d AS (SELECT face_id, lat, lon, min((sqrt(pow(ax + f * dx, 2) + pow(ay + f * dy, 2)), lat + ay + f * dy, lon + ax + f * dx)) AS hit FROM q GROUP BY ALL),
    near AS (SELECT face_id, lat, lon, hit[1] * pi() * 6378137 / 180 AS metres, hit[2] AS y, hit[3] AS x FROM d)"""


@REG.add("shore_distance", f"""WITH {POINTS_SQL}, {SEGMENTS_SQL}
    SELECT face_id, CASE WHEN metres <= 1000000 THEN CASE WHEN metres < 1852 THEN 0 ELSE round(metres / 1852, 6) END END AS distance_to_shore_nm,
           CASE WHEN metres <= 1000000 THEN round(CASE WHEN metres < 1852 THEN lat ELSE y END, 6) + 0.0 END AS closest_shore_lat,
           CASE WHEN metres <= 1000000 THEN round(((CASE WHEN metres < 1852 THEN lon ELSE x END + 180) % 360 + 360) % 360 - 180, 6) + 0.0 END AS closest_shore_lon FROM near""")
def shore_distance(spark, sf):
    lines = anchors(spark, sf).select(around(COAST, True).alias("line"))
    out = coast.distance_to_coast(points(spark, sf).select("face_id", "lat", "lon"), lines)
    out = out.select("face_id", F.col("distance_to_shore").alias("distance_to_shore_nm"), "closest_shore_lat", "closest_shore_lon")
    return rounded(out, *out.columns[1:])


@REG.add("shore_distance_date_line", f"""WITH {POINTS_SQL}, {SEGMENTS_SQL}
    SELECT face_id, CASE WHEN metres <= 5000000 THEN CASE WHEN metres < 2000 THEN 0 ELSE round(metres / 1000, 6) END END AS distance_to_shore_km FROM near""")
def shore_distance_date_line(spark, sf):
    lines = anchors(spark, sf).select(around(COAST, True).alias("line"))
    out = coast.distance_to_coast(points(spark, sf).select("face_id", "lat", "lon"), lines, radii_km=coast.DATE_LINE_RADII_KM, units="km")
    return rounded(out.select("face_id", F.col("distance_to_shore").alias("distance_to_shore_km")), "distance_to_shore_km")


# Even-odd rule on the rings as they go on over the date line, for all three copies of the globe.
RINGS_SQL = f"""{ANCHOR_SQL}, vertex AS {vertices_sql(RING)},
    edge AS (SELECT a.k, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM vertex a JOIN vertex b ON a.k = b.k AND b.i = (a.i + 1) % {len(RING)}),
    turns AS (SELECT face_id, k, turn FROM points, edge, (VALUES (-360), (0), (360)) AS t(turn) WHERE (y1 > lat) <> (y2 > lat) AND lon + turn < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 GROUP BY ALL HAVING count(*) % 2 = 1),
    hits AS (SELECT DISTINCT face_id, k FROM turns)"""


def rings(spark, sf):
    return anchors(spark, sf).select("k", "balance", around(RING, True).alias("ring"))


@REG.add("points_in_polygons", f"WITH {POINTS_SQL}, {RINGS_SQL} SELECT face_id, k AS boundary FROM hits")
def points_in_polygons(spark, sf):
    return coast.points_in_rings(points(spark, sf), rings(spark, sf), size=5.0).select("face_id", F.col("k").alias("boundary"))


ZONES = ("America/Anchorage", "America/Adak", "America/Los_Angeles", "America/New_York", "America/St_Johns", "UTC", "Asia/Kolkata", "Pacific/Auckland", "America/Halifax")

AREA_SQL = f"area AS (SELECT k, abs(sum(x1 * y2 - x2 * y1)) / 2 AS area FROM (SELECT k, x1 - min(x1) OVER (PARTITION BY k) AS x1, x2 - min(x1) OVER (PARTITION BY k) AS x2, y1, y2 FROM edge) GROUP BY k)"


@REG.add("time_zones", f"""WITH {POINTS_SQL}, {RINGS_SQL}, {AREA_SQL}, zone AS (SELECT k, {list(ZONES)}[k % {len(ZONES)} + 1] AS zone, area FROM area JOIN anchor USING (k)),
    inside AS (SELECT face_id, arg_min(zone, (round(area, 6), zone)) AS zone FROM hits JOIN zone USING (k) GROUP BY face_id),
    m AS (SELECT face_id, k, x1 + turn - lon AS ax, y1 - lat AS ay, x2 - x1 AS dx, y2 - y1 AS dy FROM points, edge, (VALUES (-360), (0), (360)) AS t(turn) WHERE face_id NOT IN (SELECT face_id FROM inside)),
    q AS (SELECT face_id, k, ax, ay, dx, dy, coalesce(least(greatest(-(ax * dx + ay * dy) / nullif(dx * dx + dy * dy, 0), 0), 1), 0) AS f FROM m),
    near AS (SELECT face_id, arg_min(zone, (round(sqrt(pow(ax + f * dx, 2) + pow(ay + f * dy, 2)), 9), zone)) AS zone FROM q JOIN zone USING (k) GROUP BY face_id HAVING min(sqrt(pow(ax + f * dx, 2) + pow(ay + f * dy, 2))) * pi() * 6378137 / 180 <= 5000000),
    z AS (SELECT face_id, coalesce(i.zone, n.zone, 'Etc/GMT') AS zone FROM points LEFT JOIN inside i USING (face_id) LEFT JOIN near n USING (face_id))
    SELECT face_id, zone AS time_zone, CAST(trunc(date_diff('minute', TIMESTAMP '2023-07-15 12:00:00', (TIMESTAMP '2023-07-15 12:00:00' AT TIME ZONE 'UTC') AT TIME ZONE zone) / 60) AS INTEGER) AS utc_offset_hours FROM z""")
def time_zones(spark, sf):
    """Zones by position, and their offsets on a summer's day."""
    zones = rings(spark, sf).select("ring", F.element_at(F.array(*map(F.lit, ZONES)), (F.col("k") % len(ZONES) + 1).cast("int")).alias("zone"))
    return coast.time_zones(points(spark, sf), zones, size=5.0, day="2023-07-15").select("face_id", "time_zone", "utc_offset_hours")


@REG.add("boundary_geojson", f"""WITH {ANCHOR_SQL}, vertex AS {vertices_sql(RING)}
    SELECT k, CAST(i AS INTEGER) AS place, 'ring ' || k AS name, round(x, 6) + 0.0 AS lon, round(y, 6) + 0.0 AS lat FROM (FROM vertex UNION ALL SELECT k, {len(RING)}, x, y FROM vertex WHERE i = 0)""")
def boundary_geojson(spark, sf):
    """Rings as features of GeoJSON, read back: every corner, the first again at the end."""
    closed = anchors(spark, sf).select("k", around([*RING, RING[0]], False).alias("ring"), F.concat(F.lit("ring "), "k").alias("name"))
    text = writers.geojson_features(closed, "ring", ["k", "name"])
    kind = "type string, geometry struct<type: string, coordinates: array<array<array<double>>>>, properties struct<k: bigint, name: string>"
    back = text.select(F.from_json("value", kind).alias("f")).where("f.type = 'Feature' AND f.geometry.type = 'Polygon'")
    rows = back.select("f.properties.k", "f.properties.name", F.posexplode(F.col("f.geometry.coordinates")[0]).alias("place", "p"))
    return rounded(rows.select("k", "place", "name", F.col("p")[0].alias("lon"), F.col("p")[1].alias("lat")), "lon", "lat")


# A fan of triangles from node 0 over all suppliers, which stand on a circle around the date line.
FAN_SQL = "node AS (SELECT s_suppkey AS k, 10 * sin(2 * pi() * s_suppkey / (SELECT count(*) FROM supplier)) AS lat, 180 + 10 * cos(2 * pi() * s_suppkey / (SELECT count(*) FROM supplier)) AS lon FROM supplier)"


@REG.add("mesh_boundary", f"""WITH {FAN_SQL}, r AS (SELECT k, lat, lon FROM node UNION ALL SELECT (SELECT count(*) FROM node), lat, lon FROM node WHERE k = 0)
    SELECT 'POLYGON ((' || string_agg(printf('%.6f', lon) || ' ' || printf('%.6f', round(lat, 9) + 0.0), ', ' ORDER BY k) || '))' AS wkt, count(*) - 1 AS n_nodes FROM r""")
def mesh_boundary(spark, sf):
    suppliers = table(spark, sf, "supplier")
    n = suppliers.count()
    k, turn = F.col("s_suppkey"), F.lit(2 * math.pi) * F.col("s_suppkey") / n
    node = suppliers.select(F.lit("m").alias("location"), k.alias("node_id"), (F.round(10 * F.sin(turn), 9) + 0.0).alias("lat_node"), geo.normalize_longitude(180 + 10 * F.cos(turn)).alias("lon_node"))
    fan = suppliers.where((k > 0) & (k < n - 1)).select(F.lit("m").alias("location"), k.alias("face_id"), F.posexplode(F.array(F.lit(0).cast("long"), k, k + 1)).alias("c", "node_id"))
    return spatial.mesh_boundary(fan.select("location", "face_id", (F.col("c") + 1).alias("corner"), "node_id"), node, ["location"]).select("wkt", "n_nodes")


STATES = ("Alaska", "Maine", "Oregon", "Florida")
REGIONS = ("Alaska", "Atlantic Coast", "Gulf of Mexico", "Hawaii")

BOUNDARY_SQL = f"""kinds AS (SELECT k, balance, k % 4 AS s, {list(STATES)}[k // 4 % 4 + 1] AS state, k % 3 AS ts, k % 5 AS eez, {list(REGIONS)}[k // 4 % 4 + 1] AS region, k % 8 = 3 AS consistent FROM anchor),
    g AS (SELECT p.face_id, coalesce(array_to_string(list_sort(list_distinct(list(state) FILTER (s = 0))), '/'), '') AS states, coalesce(bool_or(s IN (1, 2) AND ts = 1), false) AS in_ts, coalesce(bool_or(s IN (1, 2) AND eez < 2), false) AS in_eez,
                 coalesce(bool_or(s IN (1, 2) AND region = 'Atlantic Coast'), false) AS coast, coalesce(bool_or(s IN (1, 2) AND region = 'Alaska'), false) AS alaska, count(*) FILTER (s = 3) AS n, coalesce(bool_or(s = 3 AND consistent), false) AS consistent
          FROM points p LEFT JOIN hits h ON p.face_id = h.face_id LEFT JOIN kinds a ON a.k = h.k GROUP BY p.face_id)"""


def boundaries(spark, sf):
    """Rings of four kinds: state waters, two of the sea, management areas."""
    k = F.col("k")
    one_of = lambda names, n: F.element_at(F.array(*map(F.lit, names)), (n % len(names) + 1).cast("int"))
    sea = (k % 4 == 1) | (k % 4 == 2)
    return rings(spark, sf).select(
        "ring",
        one_of(("state", "sea", "sea", "czma"), k).alias("source"),
        one_of(STATES, F.floor(k / 4)).alias("stateName"),
        F.when(sea, (k % 3 == 1).cast("int")).alias("TS"),
        F.when(sea, (k % 5 < 2).cast("int")).alias("EEZ"),
        F.when(sea, one_of(REGIONS, F.floor(k / 4))).alias("REGION"),
        F.when(k % 8 == 3, "federal consistency").otherwise("inland").alias("CZMADomain"),
    )


@REG.add("jurisdiction_labels", f"""WITH {POINTS_SQL}, {RINGS_SQL}, {BOUNDARY_SQL},
    l AS (SELECT face_id, CASE WHEN states <> '' THEN [states || ' state waters', 'coastal states'] WHEN in_ts THEN CASE WHEN coast THEN ['outside', 'None'] ELSE ['territorial sea', 'territorial sea limits'] END
        WHEN in_eez THEN ['exclusive economic zone', 'exclusive economic zone limits'] WHEN n > 0 THEN CASE WHEN consistent THEN ['exclusive economic zone', 'coastal zone management areas'] ELSE ['not found', 'not found'] END
        WHEN alaska THEN ['exclusive economic zone', 'exclusive economic zone limits'] ELSE ['outside', 'None'] END AS l FROM g)
    SELECT face_id, l[1] AS jurisdiction, l[2] AS jurisdiction_source FROM l""")
def jurisdiction_labels(spark, sf):
    """Rings overlap here, so two states are joined."""
    return coast.label_points(points(spark, sf), boundaries(spark, sf), ["face_id"], size=5.0, two_states="join")


@REG.add("jurisdiction_date_line", f"""WITH {POINTS_SQL}, {RINGS_SQL}, {BOUNDARY_SQL},
    l AS (SELECT face_id, CASE WHEN states <> '' THEN [states || ' state waters', 'coastal states'] WHEN in_ts THEN ['territorial sea', 'territorial sea limits']
        WHEN in_eez THEN ['exclusive economic zone', 'exclusive economic zone limits'] ELSE ['outside', 'None'] END AS l FROM g)
    SELECT face_id, l[1] AS jurisdiction, l[2] AS jurisdiction_source FROM l""")
def jurisdiction_date_line(spark, sf):
    return coast.label_points(points(spark, sf), boundaries(spark, sf), ["face_id"], size=5.0, date_line=True, two_states="join")
