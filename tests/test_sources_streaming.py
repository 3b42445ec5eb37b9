import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from halocline.sources import readers, writers
from halocline.streaming import rollups

SF = "/root/testdata/sf0.001"


def test_points_roundtrip(spark, tmp_path):
    rows = [(i, dt.datetime(2007, 1, 1, h), 59.10 + 0.004 * i, -152.7890123, float(h)) for i in range(5) for h in range(3)]
    df = spark.createDataFrame(rows, "face_id long, time timestamp, lat double, lon double, u double")
    path = f"{tmp_path}/points"
    writers.write_points(df, path)
    files = readers.list_files(spark, path, "*.parquet")
    assert files.count() >= 2 and readers.newest(files).count() == 1
    back = readers.read_points(spark, path, lat_deg=59, lon_deg=-152)
    assert back.count() == 15 and readers.read_points(spark, path, lat_deg=58).count() == 0
    plan = back._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(lat_deg" in plan


def test_schema_and_nan(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 1.5, float("nan"))], "location string, node_id long, lat_node float, lon_node float").withColumns({"x": F.lit(1.0).cast("float"), "y": F.lit(None).cast("float")})
    df.write.parquet(f"{tmp_path}/node")
    r = readers.read_fact(spark, f"{tmp_path}/node", "node").first()
    assert r.lon_node is None and r.lat_node == 1.5
    assert readers.schema_problems(df.drop("x").withColumn("node_id", F.lit(1)), readers.schema("node")) == [("node_id", "int for bigint"), ("x", "missing")]
    assert readers.schema_problems(df.withColumn("x", F.lit(1.0)), readers.schema("node")) == []


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, 1.0), (1, 1, float("nan"))], "face_id int, sigma_layer int, u double")
    wide = writers.export_wide(df, ["face_id"], ["u"], layers=2).first()
    assert (wide.u_sigma_layer_01, wide.u_sigma_layer_02) == (1.0, -999.0)
    writers.write_summary(df, f"{tmp_path}/s", "archival")
    assert dict(spark.read.parquet(f"{tmp_path}/s").dtypes)["u"] == "float"
    ring = F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(0.0).alias("lat")) for x in (0.0, 1.0, 0.0)])
    shaped = df.limit(1).withColumn("ring", ring)
    feature = json.loads(writers.geojson_features(shaped, "ring", ["face_id"]).first().value)
    assert feature["geometry"]["coordinates"] == [[[0, 0], [1, 0], [0, 0]]] and feature["properties"] == {"face_id": 1}
    assert shaped.select(writers.wkt_polygon("ring")).first()[0].startswith("POLYGON ((0.000000 0.000000, 1")
    assert writers.row_group_rows(392_002, 8760) == 100 and writers.row_group_rows(50, 10) == 50


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("time"), "value")
    source = f"{tmp_path}/in"
    events.unionByName(events).repartition(3).write.parquet(source)  # every row twice
    stream = lambda: spark.readStream.schema(events.schema).parquet(source)
    once = rollups.first_rows(stream(), ["user_id"], lateness="60 days")
    rollups.write(once, f"{tmp_path}/rows", f"{tmp_path}/c1").awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/rows")
    assert rows.count() == events.select("user_id", "time").distinct().count()
    query = rollups.upsert(rollups.tumbling(stream(), ["user_id"], "value", lateness="60 days"), f"{tmp_path}/daily", f"{tmp_path}/c2")
    query.awaitTermination()
    got = rollups.latest_updates(spark.read.parquet(f"{tmp_path}/daily"), ["user_id", "window_start"])
    want = rollups.tumbling(events.unionByName(events), ["user_id"], "value")
    digest = lambda d: sorted((r.user_id, r.window_start, r.n, round(r.mean, 6), r.min, r.max) for r in d.collect())
    assert digest(got) == digest(want)
    shifted = rollups.tumbling(events, ["user_id"], "value", "5 days", "3 days").agg(F.min("window_start")).first()[0]
    assert (shifted - dt.datetime(1970, 1, 4)).days % 5 == 0
    assert rollups.monthly(events, ["user_id"], "value").agg(F.sum("n")).first()[0] == events.count()


def test_manifest_is_written_and_read(spark, tmp_path):
    from halocline.operators import spatial
    from halocline.sources import manifest

    points = spark.createDataFrame([("cook", 7, 61.4657288, -149.6356201), ("cook", 8, 61.4650000, -149.6350000), ("bay", 9, 10.5, 20.25)], "location string, face_id long, lat double, lon double")
    cells = spatial.grid_points(points)
    spec = spark.createDataFrame([("2.0.0", "1.0.0", "b1", 2, 8, "{location}/{data_version}/{data_level}/lat_deg={lat_deg}/lon_deg={lon_deg}/lat_dec={lat_dec}/lon_dec={lon_dec}/{face_id}.{lat}.{lon}-{temporal}.{date}.{time}", "s3://b/t/", None)], manifest.SPEC)
    locations = spark.createDataFrame([("cook", "1.2.0", "1h", "20050101", "000000")], manifest.LOCATIONS)
    manifest.write(spec, locations, spatial.grid_index(cells), spatial.grid_point_lists(cells), str(tmp_path))
    m = manifest.load(spark, str(tmp_path))
    cell = m.cell("61_-149_46_63")
    assert sorted((r.face_id, r.lat) for r in cell.collect()) == [("00000007", "61.4657288"), ("00000008", "61.4650000")]
    got = {r.face_id: r.path for r in m.paths(cell).collect()}
    assert got["00000007"] == "cook/1.2.0/b1/lat_deg=61/lon_deg=-149/lat_dec=46/lon_dec=63/00000007.61.4657288.-149.6356201-1h.20050101.000000"
    assert {r.path.split("/")[1] for r in m.paths(cell, "9.0.0").collect()} == {"9.0.0"}
    assert [r.path for r in m.paths(m.cell("10_20_50_25")).collect()] == [None]
    row = m.paths(cell).select(m.full_path("path", F.lit(False)).alias("a"), m.full_path("path", F.lit(True)).alias("b")).first()
    assert row.a.startswith("s3://b/t/cook/") and row.b is None
    manifest.write(spec.withColumn("spec_version", F.lit("1.9.0")), locations, spatial.grid_index(cells), spatial.grid_point_lists(cells), f"{tmp_path}/old")
    with pytest.raises(ValueError, match="1.9.0"):
        manifest.load(spark, f"{tmp_path}/old")


def test_daily_archive_skips_days_that_are_there(spark, tmp_path):
    rows = [(1, dt.datetime(2007, 1, d, h), float(h)) for d in (1, 2) for h in range(4)]
    df = spark.createDataFrame(rows, "face_id long, time timestamp, speed double")
    at = f"{tmp_path}/daily"
    writers.write_daily(df.where("day(time) = 1"), at)
    writers.write_daily(df.withColumn("speed", F.col("speed") + 100), at)
    got = spark.read.parquet(at)
    assert got.count() == 8 and got.where("speed >= 100").select("day").distinct().count() == 1
    writers.write_daily(df.where("day(time) = 2"), at, skip_existing=False)
    assert spark.read.parquet(at).count() == 12


def test_hotspots_as_csv(spark, tmp_path):
    rows = [(2, 8, 1.25, -3.5, 0.5, 100.0), (1, 7, 1.0, 2.0, None, 100.0)]
    writers.write_hotspots(spark.createDataFrame(rows, writers.HOTSPOTS), f"{tmp_path}/spots")
    assert [tuple(r) for r in readers.read_hotspots(spark, f"{tmp_path}/spots").orderBy("rank").collect()] == sorted(rows)


def test_updates_are_compacted_and_a_restart_goes_on(spark, tmp_path):
    source, out, state = (f"{tmp_path}/{n}" for n in ("source", "out", "state"))
    schema = "face_id long, time timestamp, zeta double"
    seen = []
    for day in (1, 2, 3):
        rows = [(f, dt.datetime(2007, 1, day, h), float(day + f + h)) for f in (1, 2) for h in range(3)]
        seen += rows
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = rollups.monthly(spark.readStream.schema(schema).parquet(source), ["face_id"], "zeta", lateness="30 days")
        rollups.upsert(stream, out, state).awaitTermination()  # a new query each time, from the same checkpoint
        if day == 2:
            compacted = rollups.compact(spark, out, ["face_id", "month"], f"{tmp_path}/compacted")
    batch = rollups.monthly(spark.createDataFrame(seen, schema), ["face_id"], "zeta")
    got = rollups.since(spark, out, compacted, ["face_id", "month"])
    key = lambda df: sorted((r.face_id, r.month, r.n, r.min, r.max, round(r["mean"], 9)) for r in df.collect())
    assert key(got) == key(batch) == key(rollups.latest_updates(spark.read.parquet(out), ["face_id", "month"]))


def test_rows_later_than_the_watermark_are_left_out(spark, tmp_path):
    source, out, state = (f"{tmp_path}/{n}" for n in ("source", "out", "state"))
    schema = "face_id long, time timestamp, zeta double"
    for rows in ([(1, dt.datetime(2007, 1, 1, 0), 1.0), (1, dt.datetime(2007, 1, 20, 0), 2.0)], [(1, dt.datetime(2007, 1, 1, 1), 9.0), (1, dt.datetime(2007, 1, 25, 0), 3.0)], [(1, dt.datetime(2007, 2, 20, 0), 4.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        daily = rollups.tumbling(spark.readStream.schema(schema).parquet(source), ["face_id"], "zeta", lateness="2 days")
        rollups.write(daily, out, state).awaitTermination()
    days = {r.window_start.day: r.n for r in spark.read.schema("face_id long, window_start timestamp, n long").parquet(out).collect() if r.window_start.month == 1}
    assert days[1] == 1 and days[20] == 1 and days[25] == 1
