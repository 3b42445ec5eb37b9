import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from halocline.operators import bookkeeping, derive, regions, reshape, spatial, summary, tides, timeline
from halocline.plans import hindcast

T0 = dt.datetime(2007, 1, 1)


def test_gap_calendar(spark):
    steps = [k for k in range(96) if k not in (10, 11, 12, 90)]
    rows = [(1, T0 + dt.timedelta(minutes=30 * k), float(k), "a") for k in steps] + [(1, T0, 99.0, "b")]
    df = spark.createDataFrame(rows, "face_id int, time timestamp_ntz, x double, source_file string")
    first = timeline.keep_first(df, ["face_id", "time"], ["source_file"])
    assert first.count() == 92 and first.where("x = 99").count() == 0
    cal = timeline.calendar(spark, "2007-01-01 00:00:00", "2007-01-02 23:30:00", 1800)
    assert cal.count() == 96
    padded = reshape.fill(timeline.pad(first, ["face_id"], cal), ["x"])
    assert padded.count() == 96 and padded.where("x = -999").count() == 4
    lost = timeline.missing(first, ["face_id"], cal)
    index = lost.select("face_id", ((F.unix_micros(F.col("time").cast("timestamp")) - F.lit(int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6))) / 1_800_000_000).cast("long").alias("k"))
    assert timeline.index_ranges(index, ["face_id"], "k").first().ranges == "10-12,90"
    assert timeline.bad_pairs(first, ["face_id"], 1800).count() == 2
    assert df.select(timeline.step_name(F.lit(3600.0)), timeline.step_name(F.lit(7.0))).first()[:2] == ("1h", None)
    loc = hindcast.Location("x", "x", "2007-01-01 00:00:00", "2007-01-02 23:30:00", 1800)
    assert hindcast.verify(first, loc, ["face_id"]).first().problem == "steps"
    assert [hindcast.expected_steps(v) for v in hindcast.LOCATIONS.values()] == [8760, 8760, 17520, 17472, 17520]


def test_peaks_against_definition():
    rng = np.random.default_rng(1)
    for _ in range(200):
        x = np.round(rng.normal(size=rng.integers(0, 40)), 1)
        peaks = tides.local_maxima(x)
        slow = []
        i = 1
        while i < len(x) - 1:
            j = i
            while j + 1 < len(x) and x[j + 1] == x[i]:
                j += 1
            if x[i - 1] < x[i] and j + 1 < len(x) and x[j + 1] < x[i]:
                slow.append((i + j) // 2)
            i = j + 1
        assert peaks.tolist() == slow
        for p, prom in zip(peaks, tides.prominences(x, peaks), strict=True):
            left = next((k for k in range(p, -1, -1) if x[k] > x[p]), -1)
            right = next((k for k in range(p, len(x)) if x[k] > x[p]), len(x))
            assert prom == x[p] - max(x[left + 1 : p + 1].min(), x[p:right].min())


def test_sine_tide(spark):
    period = 12.42
    rows = [(1, T0 + dt.timedelta(minutes=30 * k), math.sin(2 * math.pi * k * 0.5 / period) + 3) for k in range(2000)]
    rows += [(2, T0 + dt.timedelta(minutes=30 * k), 1.0) for k in range(20)] + [(3, T0, 5.0), (4, T0, None)]
    out = {r.face_id: r for r in tides.tidal_summary(spark.createDataFrame(rows, "face_id int, time timestamp_ntz, zeta double"), ["face_id"], "zeta").collect()}
    assert out[1].average_period_s == pytest.approx(period * 3600, rel=1e-3) and out[1].tide_type == "Semidiurnal"
    assert out[1].tidal_range == pytest.approx(2, abs=0.02) and out[1].mean_level == pytest.approx(3, abs=0.01)
    assert (out[2].tidal_range, out[2].average_period_s, out[2].tide_type) == (0, 0, "Unknown")
    assert out[3].high_max == 0 and out[4].high_max is None or math.isnan(out[4].high_max)


def test_modal_directions(spark):
    df = spark.createDataFrame([(1, d, s) for d, s in [(10.5, 1.0), (10.2, 3.0), (200.0, 2.0), (360.0, 9.0), (95.0, 1.0), (96.0, 1.0), (97.0, 1.0)]] + [(2, None, 1.0)], "f int, d double, s double")
    rows = summary.modal_directions(df, ["f"], "d", "s").collect()
    assert [tuple(r) for r in rows] == [(1, 10.0, 2.0, 200.0, 2.0)]


def test_flood_ebb_edges(spark):
    flat = [(1, k, 10.0, 1.0, 2.0) for k in range(5)] + [(2, 0, 10.0, 1.0, 2.0)] + [(3, k, None, None, float(k)) for k in range(3)]
    rows = summary.flood_ebb(spark.createDataFrame(flat, "f int, t int, d double, s double, z double"), ["f"], ["t"], "d", "s", "z").collect()
    assert len(rows) == 3 and all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0) for r in rows)
    moving = [(1, k, d, s, z) for k, (d, s, z) in enumerate([(10.0, 1.0, 0.0), (11.0, 0.4, 1.0), (190.0, 2.0, 0.0), (191.0, 0.6, -2.0)])]
    r = summary.flood_ebb(spark.createDataFrame(moving, "f int, t int, d double, s double, z double"), ["f"], ["t"], "d", "s", "z").first()
    assert (r.flood_direction, r.flood_mean_speed, r.flood_hours, r.ebb_direction, r.ebb_mean_speed, r.ebb_hours) == (10, 1.0, 0.5, 190, 1.3, 1.0)


def test_running_mean_of_buckets(spark):
    df = spark.createDataFrame([("f", 1, 2.0), ("f", 1, 4.0), ("f", 2, 9.0), ("f", 2, 9.0)], "k string, b int, x double")
    assert summary.running_surface_mean(df, ["k"], F.col("b"), "x").first()[1] == pytest.approx(3 * 2 / 3 + 9 / 3)


def mesh(spark):
    node = spark.createDataFrame([("m", i, y, x) for i, (x, y) in enumerate([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)], 1)], "location string, node_id long, lat_node double, lon_node double")
    face_node = spark.createDataFrame([("m", f, c, n) for f, ns in ((1, (1, 2, 3)), (2, (1, 3, 4))) for c, n in enumerate(ns, 1)], "location string, face_id long, corner int, node_id long")
    return node, face_node


def test_mesh(spark):
    node, face_node = mesh(spark)
    assert {(r.a, r.b) for r in spatial.boundary_edges(face_node, ["location"]).collect()} == {(1, 2), (2, 3), (3, 4), (1, 4)}
    out = spatial.mesh_boundary(face_node, node, ["location"]).first()
    assert out.n_nodes == 4 and out.wkt == "POLYGON ((0.000000 0.000000, 1.000000 0.000000, 1.000000 1.000000, 0.000000 1.000000, 0.000000 0.000000))"
    corners = {r.face_id: r for r in derive.corner_columns(face_node, node, ["location", "face_id"]).collect()}
    assert (corners[2].element_corner_2_lat, corners[2].element_corner_2_lon, corners[2].element_corner_3_lon) == (1, 1, 0)


def test_dateline_split():
    parts = spatial.split_at_dateline([(179.0, 0.0), (-179.0, 0.0), (179.0, 1.0)])
    assert len(parts) == 2 and all(max(x for x, _ in p) - min(x for x, _ in p) <= 180 for p in parts)
    assert max(x for x, _ in parts[0]) == pytest.approx(179.999) and min(x for x, _ in parts[1]) == pytest.approx(-179.999)
    assert spatial.split_at_dateline([(1.0, 0.0), (2.0, 0.0), (1.0, 1.0)]) == [[(1.0, 0.0), (2.0, 0.0), (1.0, 1.0)]]


def test_hotspots(spark):
    rows = [(i, 0.0, i * 0.001, float(100 - i)) for i in range(60)]
    faces = spark.createDataFrame(rows, "face_id long, lat double, lon double, p double")
    found = spatial.hotspots(faces, "p", 3, 1000.0, pool=5).orderBy("rank").collect()
    assert [r.face_id for r in found] == [0, 10, 20]
    relaxed = spatial.hotspots(faces, "p", 3, 5000.0).orderBy("rank").collect()
    assert relaxed[0].face_id == 0 and len(relaxed) == 3 and 1500 <= relaxed[0].spacing_m < 5000


def test_nearest_and_gap(spark):
    p = spark.createDataFrame([(1, 49.94, -174.96), (2, 49.95, -174.96), (3, 10.0, 10.0)], "face_id long, lat double, lon double")
    assert spatial.nearest(p, 49.9441, -174.9599).first().face_id == 1
    assert spatial.nearest(p, 0.0, 0.0).count() == 0 and spatial.nearest(p, 49.96, -174.96, max_degrees=0.001).count() == 0
    d = spark.createDataFrame([("a", float(x)) for x in [*range(60), 500, 501]], "k string, d double")
    assert spatial.until_gap(d, ["k"], "d").count() == 60


def test_jurisdiction_rules(spark):
    rows = [
        (1, "sea", None, 1, 0, "Gulf of Mexico", None),
        (2, "sea", None, 1, 1, "Atlantic Coast", None),
        (3, "sea", None, 0, 1, "Atlantic Coast", None),
        (4, "czma", None, None, None, None, "federal consistency by state"),
        (5, "czma", None, None, None, None, "inland"),
        (6, "sea", None, 0, 0, "Alaska", None),
        (7, None, None, None, None, None, None),
        (8, "sea", None, 1, 0, "Atlantic Coast", None),
        (8, "state", "Maine", None, None, None, None),
        (9, "czma", None, None, None, None, "federal consistency"),
        (9, "czma", None, None, None, None, "inland"),
        (10, "czma", None, None, None, None, "federal consistency by state"),
        (10, "czma", None, None, None, None, "inland"),
    ]
    df = spark.createDataFrame(rows, "id int, source string, stateName string, TS int, EEZ int, REGION string, CZMADomain string")
    eez = "exclusive economic zone"
    assert {r.id: r.jurisdiction for r in spatial.jurisdiction(df, ["id"]).collect()} == {1: "territorial sea", 2: "outside", 3: eez, 4: eez, 5: "not found", 6: eez, 7: "outside", 8: "Maine state waters", 9: eez, 10: "not found"}


def test_convex_hull():
    assert spatial.convex_hull([(0, 0), (2, 0), (1, 1), (2, 2), (0, 2), (1, 0)]) == [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]
    assert spatial.convex_hull([(1, 1)]) == [(1, 1), (1, 1)]
    assert spatial.convex_hull([]) == []


def test_jurisdiction(spark):
    df = spark.createDataFrame([(1, "noaa", 0.0, 1.0, 0.0, None), (1, "state", None, None, None, "Maine"), (2, "noaa", 0.0, 1.0, 0.0, None), (3, "noaa", 0.0, 0.0, 0.0, None)], "id int, source string, TS double, EEZ double, CZ double, stateName string")
    assert {r.id: r.jurisdiction for r in spatial.jurisdiction(df, ["id"]).collect()} == {1: "Maine state waters", 2: "exclusive economic zone", 3: "outside"}


def test_bookkeeping(spark):
    files = spark.createDataFrame([(f"p/{i:03d}", i) for i in range(100)], "relative_path string, n int").repartition(7)
    m = bookkeeping.build_manifest(files)
    assert [r.file_index for r in m.orderBy("relative_path").collect()] == list(range(100))
    assert [r.file_index for r in bookkeeping.batch_slice(m, 3, 30).collect()] == list(range(90, 100))
    found = spark.createDataFrame([(0, 0, 4), (1, 5, 9), (3, 15, 19)], "batch long, first long, last long")
    assert [r.batch for r in reshape.missing_batches(found, 20, 5).collect()] == [2]
    assert [r.batch for r in reshape.batch_continuity(found).collect()] == [3]


def test_circular_and_classes(spark):
    df = spark.createDataFrame([(1, 350.0), (1, 10.0)], "k int, to_direction double")
    assert summary.depth_average(df, ["k"], ["to_direction"]).first()[1] == 180
    assert summary.depth_average(df, ["k"], ["to_direction"], circular=True).first()[1] % 360 == pytest.approx(0, abs=1e-9)
    assert summary.percentile_name(0.9999) == "99_99" and summary.percentile_name(0.95) == "95"
    assert regions.histogram(spark.createDataFrame([(1, 0.0), (1, 10.0), (1, 11.0)], "k int, x double"), ["k"], "x", 0, 10, 5).orderBy("bin").collect()[1].bin == 4


def test_hindcast_end_to_end(spark):
    """Two triangles, two layers, two days of a sine: raw rows to one wide row per face."""
    loc = hindcast.Location("piscataqua_river", "NH", "2007-01-01 00:00:00", "2007-01-03 23:00:00", 3600)
    hours = range(72)
    node, face_node = mesh(spark)
    z = [("m", n, T0 + dt.timedelta(hours=k), math.sin(2 * math.pi * k / 12.42)) for n in range(1, 5) for k in hours]
    zeta = spark.createDataFrame(z, "location string, node_id long, time timestamp_ntz, zeta double")
    face = spark.createDataFrame([("m", f, 0.3 * f, 0.5, 10.0, 0.1) for f in (1, 2)], "location string, face_id long, lat_center double, lon_center double, h_center double, mean_navd88_offset double")
    v = [("m", f, T0 + dt.timedelta(hours=k), s, math.cos(2 * math.pi * k / 12.42) * (2 - s), 0.0, "file") for f in (1, 2) for s in (0, 1) for k in [*hours, 5]]
    velocity = spark.createDataFrame(v, "location string, face_id long, time timestamp_ntz, sigma_layer int, u double, v double, source_file string")
    clean = hindcast.standardize(velocity, loc, ["location", "face_id", "sigma_layer"], ["source_file"])
    assert clean.count() == 2 * 2 * 72
    assert hindcast.verify(clean.where("sigma_layer = 0"), loc, ["location", "face_id"]).count() == 0
    layers = hindcast.derive_layers(clean)
    out = hindcast.summarize(layers, hindcast.derive_columns(layers), hindcast.derive_surface(zeta, face_node, face), loc)
    rows = out.orderBy("face_id").collect()
    assert len(rows) == 2
    r = rows[0]
    assert r.surface_speed_max == 2.0 and r.water_column_max_speed_max == 2.0 and r.water_column_mean_speed_mean == pytest.approx(0.75 * r.surface_speed_mean, rel=1e-9)
    assert r.average_period_s == pytest.approx(12.42 * 3600, rel=0.05) and r.water_column_height_max == pytest.approx(11, abs=0.01)
    assert r.speed_sigma_level_1 == r.surface_speed_mean and r.speed_sigma_level_3 is None
    assert r.flood_direction_depth_avg == 90 and r.ebb_direction_depth_avg in (90, 270)
    wide = hindcast.atlas({"piscataqua_river": out}, face.withColumn("location", F.lit("NH_piscataqua_river")))
    assert wide.first().location == "NH_piscataqua_river" and wide.where("full_year_data_uri is not null").count() == 2
    assert hindcast.summarize(layers, hindcast.derive_columns(layers), hindcast.derive_surface(zeta, face_node, face), loc, "month").count() == 2


def test_shore_distance_across_the_date_line_and_at_the_pole(spark):
    """Against every pair by haversine."""
    import math
    import random

    from halocline.operators.spatial import densify, distance_to_shore

    rnd = random.Random(3)
    shore = [(0.0, -179.999), (51.0, 179.95), (-60.0, 10.0), (89.0, 120.0), (10.0, 10.0), (10.0, 10.0)] + [(rnd.uniform(-80, 80), rnd.uniform(-180, 180)) for _ in range(40)]
    faces = [(0.0, 180.0), (0.0, 179.99), (51.0, -179.9), (90.0, 0.0), (89.5, -60.0), (-90.0, 0.0), (10.001, 10.0), (-70.0, -180.0)] + [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(80)]

    def km(a, b, c, d):
        h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * 6371 * math.asin(min(1, math.sqrt(h)))

    p = spark.createDataFrame([(i, *x, "k") for i, x in enumerate(faces)], "face_id long, lat double, lon double, km string")
    rows = distance_to_shore(p, spark.createDataFrame(shore, "lat double, lon double"), ["face_id"]).collect()
    assert len(rows) == len(faces)
    for r in rows:
        least = min(km(*faces[r.face_id], *s) for s in shore)
        if least > 1000:
            assert r.distance_to_shore_nm is None
        else:
            assert abs(r.distance_to_shore_nm - (0 if least < 1.852 else least / 1.852)) < 1e-6
            if least >= 1.852:
                assert abs(km(*faces[r.face_id], r.closest_shore_lat, r.closest_shore_lon) - least) < 1e-6

    line = spark.createDataFrame([([(179.9, 50.0), (-179.9, 50.1)],), ([(5.0, 5.0)],)], "line array<struct<lon: double, lat: double>>")
    dots = sorted((round(r.lat, 6), round(r.lon, 6)) for r in densify(line, "line", 5.0).collect())
    assert (50.0, 179.9) in dots and (50.1, -179.9) in dots and (5.0, 5.0) in dots and len(dots) == 6
    assert all(abs(abs(lon) - 180) <= 0.1 for lat, lon in dots if lat > 10)
