"""Provenance, attributes, publishing and tracking on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from halocline.operators import provenance
from halocline.operators.spatial import grid_index, grid_point_lists, grid_points
from halocline.plans.space_queries import CELLS_SQL
from halocline.plans.tables import POINTS_SQL, SERIES_SQL, Registry, points, rounded, series, table
from halocline.sources import attributes, manifest, publish, readers, tracking, writers
from halocline.sources.shared import shared_dir

REG = Registry()

#: Orders as files of five data levels, each made from two files of the level below.
LEVELS = ("00", "a1", "a2", "b1", "b2")
FILES_SQL = f"""files AS (SELECT o_orderkey AS k, {list(LEVELS)}[o_orderkey % 5 + 1] || '/' || o_orderkey || '.nc' AS file, {list(LEVELS)}[o_orderkey % 5 + 1] AS level, sha256(CAST(o_custkey AS VARCHAR)) AS hash FROM orders),
    inputs AS (SELECT a.file AS file, b.file AS input FROM files a JOIN files b ON b.k IN (a.k - 1, a.k - 6) WHERE a.k % 5 > 0),
    behind AS (SELECT file, input AS ancestor, 1 AS steps FROM inputs UNION ALL SELECT b.file, i.input, b.steps + 1 FROM behind b JOIN inputs i ON i.file = b.ancestor),
    ancestors AS (SELECT file, ancestor, min(steps) AS steps FROM behind GROUP BY ALL)"""


def files_and_inputs(spark, sf):
    k = F.col("o_orderkey")
    level = lambda c: F.element_at(F.array(*map(F.lit, LEVELS)), (F.pmod(c, F.lit(5)) + 1).cast("int"))
    name = lambda c: F.concat(level(c), F.lit("/"), c.cast("string"), F.lit(".nc"))
    orders = table(spark, sf, "orders")
    files = orders.select(name(k).alias("file"), level(k).alias("level"), F.sha2(F.col("o_custkey").cast("string"), 256).alias("hash"))
    inputs = orders.where(k % 5 > 0).select(name(k).alias("file"), F.explode(F.array(k - 1, k - 6)).alias("i")).select("file", name(F.col("i")).alias("input"))
    return files, inputs.join(files.select(F.col("file").alias("input")), "input", "left_semi")


@REG.add("file_ancestors", f"WITH RECURSIVE {FILES_SQL} SELECT file, ancestor, CAST(steps AS INTEGER) AS steps FROM ancestors")
def file_ancestors(spark, sf):
    return provenance.ancestors(files_and_inputs(spark, sf)[1])


@REG.add("input_history", f"""WITH RECURSIVE {FILES_SQL}, r AS (SELECT a.file, f.level, f.file AS path, f.hash FROM ancestors a JOIN files f ON f.file = a.ancestor)
    SELECT file, level, count(*) AS n_files, string_agg(path || ' ' || hash, ',' ORDER BY path) AS files FROM r GROUP BY ALL""")
def input_history(spark, sf):
    """Each file's history, written as text and read back."""
    files, inputs = files_and_inputs(spark, sf)
    text = provenance.input_history(inputs, files).select("file", provenance.history_json().alias("text"))
    rows = text.select("file", F.explode(provenance.parse_history("text")).alias("h"))
    listed = F.array_join(F.transform("h.files", lambda f: F.concat_ws(" ", f["path"], f["hash"]["value"])), ",")
    return rows.select("file", "h.level", F.size("h.files").cast("long").alias("n_files"), listed.alias("files"))


@REG.add("root_files", f"""WITH RECURSIVE {FILES_SQL} SELECT file, ancestor AS root, CAST(steps AS INTEGER) AS steps, CAST(row_number() OVER (PARTITION BY file ORDER BY steps DESC, ancestor) AS INTEGER) AS place
    FROM ancestors WHERE ancestor NOT IN (SELECT file FROM inputs)""")
def root_files(spark, sf):
    return provenance.roots(files_and_inputs(spark, sf)[1])


#: Attributes as a model's files have them; the dataset's bounds are computed.
VARIABLES = {"zeta": {"units": "m", "standard_name": "sea_surface_height", "valid_range": [-5.0, 5.0]}, "lat": {"units": "degrees_north"}, "lon": {"units": "degrees_east"}}

BOUND_VALUES = "geospatial_lat_max geospatial_lat_min geospatial_lon_max geospatial_lon_min time_coverage_duration_s".split()


@REG.add("dataset_attributes", f"""WITH {POINTS_SQL}, {SERIES_SQL}, j AS (SELECT lat, lon, CASE WHEN lon < 0 THEN lon + 360 ELSE lon END AS east, time FROM series JOIN points USING (face_id)),
    b AS (SELECT min(lat) AS a, max(lat) AS b, max(east) - min(east) < max(lon) - min(lon) AS shift, min(lon) AS c, max(lon) AS d, min(east) AS e, max(east) AS f, min(time) AS s, max(time) AS t FROM j),
    r AS (SELECT unnest([('', 'geospatial_lat_min', printf('%.6f', a)), ('', 'geospatial_lat_max', printf('%.6f', b)), ('', 'geospatial_lon_min', printf('%.6f', CASE WHEN shift THEN e ELSE c END)), ('', 'geospatial_lon_max', printf('%.6f', CASE WHEN shift THEN f ELSE d END)),
        ('', 'geospatial_lat_units', 'degrees_north'), ('', 'geospatial_lon_units', 'degrees_east'), ('', 'time_coverage_start', strftime(s, '%Y-%m-%dT%H:%M:%SZ')), ('', 'time_coverage_end', strftime(t, '%Y-%m-%dT%H:%M:%SZ')),
        ('', 'time_coverage_duration_s', printf('%.6f', date_diff('microsecond', s, t) / 1e6::DOUBLE)), ('', 'title', 'hindcast'), ('zeta', 'units', 'm'), ('zeta', 'standard_name', 'sea_surface_height'), ('zeta', 'valid_range', '[-5.0, 5.0]'),
        ('lat', 'units', 'degrees_north'), ('lon', 'units', 'degrees_east'), ('level', 'units', 'm'), ('level', 'standard_name', 'sea_surface_height'), ('level', 'valid_range', '[-5.0, 5.0]')]) AS r FROM b)
    SELECT r[1] AS variable, r[2] AS attribute, r[3] AS value FROM r""")
def dataset_attributes(spark, sf):
    """Attached, written, read, derived from and carried on: all attributes of the last table."""
    facts = series(spark, sf).join(points(spark, sf).select("face_id", "lat", "lon"), "face_id").select("face_id", "lat", "lon", "time", "zeta")
    path = shared_dir(spark)
    attributes.with_attributes(facts, VARIABLES, {"title": "hindcast"} | attributes.bounds(facts)).write.parquet(path)
    read = spark.read.parquet(path)
    derived = read.withColumn("level", F.col("zeta") * 2)
    rows = attributes.attribute_table(attributes.carry(derived, read, {"level": "zeta"}))
    number = F.format_string("%.6f", F.col("value").cast("double"))
    return rows.withColumn("value", F.when(F.col("attribute").isin(BOUND_VALUES), number).otherwise(F.col("value")))


@REG.add("published_versions", f"""WITH {CELLS_SQL}, v AS (SELECT unnest([('1.0.0', 0), ('1.0.1', 1)]) AS v)
    SELECT v[1] AS version, CASE WHEN v[2] = 0 THEN count(*) ELSE count(*) FILTER (n > 0 AND lat_min > -80) END AS n_cells, CAST(CASE WHEN v[2] = 0 THEN sum(n) ELSE sum(n) FILTER (lat_min > -80) END AS BIGINT) AS n_points FROM ix, v GROUP BY v""")
def published_versions(spark, sf):
    """A manifest, the same again in another order, and one of fewer cells: two versions."""
    cells = grid_points(points(spark, sf))
    index, lists = grid_index(cells), grid_point_lists(cells)
    spec = spark.createDataFrame([("2.0.0", "", "b4", 2, 8, "{location}/{face_id}", "s3://bucket", "/data")], manifest.SPEC)
    locations = points(spark, sf).select("location").distinct().select("location", F.lit("1.0.0").alias("latest_version"), F.lit("1h").alias("temporal"), F.lit("20070101").alias("date"), F.lit("000000").alias("time"))
    base = shared_dir(spark)
    publish.publish(spec, locations, index, lists, base)
    publish.publish(spec, locations, index.orderBy("n", "grid_id"), lists.repartition(3), base)
    south = index.where("lat_min > -80")
    publish.publish(spec, locations, south, lists.join(south, "grid_id", "left_semi"), base)
    found = [publish.load(spark, base, v).index.agg(F.count("*").alias("n_cells"), F.sum("n").alias("n_points")).select(F.lit(v).alias("version"), "n_cells", "n_points") for v in publish.published(spark, base)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


@REG.add("tracked_problems", f"""WITH {SERIES_SQL}, r AS (SELECT dayname(time) AS file, count(*) FILTER (NOT zeta BETWEEN 0.01::DOUBLE AND 1.5::DOUBLE) AS off, count(DISTINCT face_id) AS n FROM series GROUP BY 1), total AS (SELECT count(DISTINCT face_id) AS all_faces FROM series)
    SELECT file, 'range' AS "check", 'zeta: ' || off AS detail FROM r WHERE off > 0 UNION ALL SELECT file, 'faces', (all_faces - n) || ' missing, 0 strange' FROM r, total WHERE n < all_faces""")
def tracked_problems(spark, sf):
    """A file per day of the week, verified in two runs; the second reads what the first has not."""
    s = series(spark, sf).select("face_id", "time", "zeta", F.date_format("time", "EEEE").alias("weekday"))
    path = shared_dir(spark)
    s.repartition("weekday").write.partitionBy("weekday").parquet(path)
    files = readers.list_files(spark, path, "*.parquet")
    track = tracking.Tracking(spark, shared_dir(spark), "1")
    checks = {"range": tracking.range_check({"zeta": (0.01, 1.5)}), "faces": tracking.face_set_check(s)}
    track.verify(files.where(F.col("path").rlike("weekday=[MT]")), checks)
    track.verify(files, checks)
    return track.problems(files).select(F.regexp_extract("file", r"weekday=(\w+)", 1).alias("file"), "check", "detail")
