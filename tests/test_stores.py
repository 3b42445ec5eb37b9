"""Reading hits, incremental extraction, publishing and tracking, with runs that die."""

import datetime as dt
import os
import statistics

import pytest
from pyspark.sql import functions as F

from halocline.functions import names
from halocline.operators import spatial
from halocline.plans import store_queries
from halocline.sources import extract, hits, manifest, publish, readers, tracking, writers

T0 = dt.datetime(2024, 1, 1)


def facts(spark, faces=12, steps=20):
    rows = [(f, 10.0 + f * 0.013, -0.05 + f * 0.013, T0 + dt.timedelta(hours=k), float(f * 100 + k)) for f in range(faces) for k in range(steps)]
    return spark.createDataFrame(rows, "face_id long, lat double, lon double, time timestamp_ntz, zeta double")


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("points"))
    writers.write_points(facts(spark), path)
    return path


def scanned(df):
    """Folders of the files in the plan."""
    return {"/".join(f.split("/")[-5:-1]) for f in df.inputFiles()}


def test_only_folders_of_hits_are_read(spark, store):
    near = facts(spark).where("face_id IN (3, 4)").select("face_id", "lat", "lon", F.lit(1).alias("rank"))
    got = hits.read_hits(spark, store, near.unionByName(near))
    assert got.count() == 40 and {r.face_id for r in got.select("face_id").collect()} == {3, 4}
    assert len(scanned(got)) == 2 and all(s.startswith("lat_deg=10/lon_deg=0/lat_dec=0") for s in scanned(got))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(face_id" in plan or "face_id#" in plan and "IN (3,4)" in plan.replace(", ", ",")
    assert {r.lat_dec for r in got.select("lat_dec").distinct().collect()} == {"03", "05"}


def test_time_window_cells_and_unknown_places(spark, store):
    near = facts(spark).where("face_id = 7").select("face_id", "lat", "lon").limit(1)
    some = hits.read_hits(spark, store, near, "2024-01-01 03:00:00", "2024-01-01 05:00:00")
    assert sorted(r.zeta for r in some.collect()) == [703.0, 704.0, 705.0]
    cells = spark.createDataFrame([("10_0_03_01",), ("10_0_03_01",), ("50_3_00_00",)], "grid_id string")
    assert {r.face_id for r in hits.read_hits(spark, store, cells).collect()} == {3}
    nowhere = spark.createDataFrame([(1, -60.0, 100.0), (2, None, None)], "face_id long, lat double, lon double")
    empty = hits.read_hits(spark, store, nowhere)
    assert empty.count() == 0 and set(empty.columns) == set(hits.read_hits(spark, store, near).columns)


def test_many_cells_are_joined(spark, store):
    every = facts(spark).select("face_id", "lat", "lon").distinct()
    assert hits.read_hits(spark, store, every, most_cells=3).count() == 240
    assert hits.read_hits(spark, store, every.where("face_id > 5"), most_cells=3).count() == 120


@pytest.fixture(scope="module")
def coarse(spark, tmp_path_factory):
    """The same rows in a folder for each degree of latitude, and a face 3 that has been in a second cell of it."""
    path = str(tmp_path_factory.mktemp("degrees"))
    moved = facts(spark, faces=4, steps=1).where("face_id = 3").withColumns({"lat": F.lit(10.5), "lon": F.lit(-0.5), "zeta": F.lit(-1.0)})
    south = facts(spark, faces=2, steps=1).withColumns({"face_id": F.col("face_id") + 100, "lat": -F.col("lat") - 20})
    writers.write_points(facts(spark).unionByName(moved).unionByName(south), path, folders=1)
    return path


def test_files_of_the_queries_store_do_not_grow_with_cells(spark):
    path = store_queries.store(spark, "/root/testdata/sf0.01")
    rows = spark.read.parquet(path)
    files = len(rows.inputFiles())
    degrees, cells = rows.select("lat_deg").distinct().count(), rows.select(*hits.KEYS).distinct().count()
    assert hits.folder_keys(spark, path) == ("lat_deg",) and files <= degrees + 4 < cells


@pytest.mark.parametrize("folders", range(5))
def test_any_depth_of_folders_has_the_same_hits(spark, tmp_path, folders):
    path = str(tmp_path / "points")
    writers.write_points(facts(spark), path, folders=folders)
    assert hits.folder_keys(spark, path) == hits.KEYS[:folders]
    near = facts(spark).where("face_id IN (3, 4, 11)").select("face_id", "lat", "lon")
    got = hits.read_hits(spark, path, near, "2024-01-01 03:00:00", "2024-01-01 05:00:00").select("face_id", "time", "zeta", *hits.KEYS)
    assert sorted(r.zeta for r in got.collect()) == [float(f * 100 + k) for f in (3, 4, 11) for k in (3, 4, 5)]
    assert {(r.lat_deg, r.lon_deg, r.lat_dec, r.lon_dec) for r in got.collect()} == {(10, 0, "03", "01"), (10, 0, "05", "00"), (10, 0, "14", "09")}
    assert hits.read_hits(spark, path, near, most_cells=1).count() == 60


def test_few_folders_keep_cells_apart(spark, coarse):
    assert sorted(os.listdir(coarse))[-2:] == ["lat_deg=-30", "lat_deg=10"] and hits.folder_keys(spark, coarse) == ("lat_deg",)
    near = facts(spark).where("face_id = 3").select("face_id", "lat", "lon")
    got = hits.read_hits(spark, coarse, near)
    assert got.count() == 20 and got.where("zeta < 0").count() == 0  # not the face's row in another cell of the folder
    assert {f.split("/")[-2] for f in got.inputFiles()} == {"lat_deg=10"}
    cells = spark.createDataFrame([("10_0_50_50",), ("-30_0_00_05",), ("50_3_00_00",), ("10_0_99_99",)], "grid_id string")
    assert sorted((r.face_id, r.zeta) for r in hits.read_hits(spark, coarse, cells).collect()) == [(3, -1.0), (100, 0.0)]
    nowhere = spark.createDataFrame([(1, -60.0, 100.0), (2, None, None)], "face_id long, lat double, lon double")
    assert hits.read_hits(spark, coarse, nowhere).count() == 0


def test_statistics_skip_other_cells_in_a_folder(spark, coarse):
    cells = spark.createDataFrame([("10_0_03_01",)], "grid_id string")
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = hits.read_hits(spark, coarse, cells)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(lon_dec,01)" in plan and "EqualTo(lat_dec,03)" in plan and "EqualTo(lon_deg,0)" in plan


def test_cells_along_a_line_are_joined_in_few_folders(spark, coarse):
    index = spatial.grid_index(spatial.grid_points(facts(spark).select("face_id", "lat", "lon").distinct()))
    found = spatial.along_line(index, (10.0, -0.05), (10.15, 0.1), 0.02)
    named, joined = (hits.read_hits(spark, coarse, found, most_cells=n) for n in (2_000, 3))
    assert sorted(r.zeta for r in named.collect()) == sorted(r.zeta for r in joined.collect()) and joined.count() == 240


def test_decimal_keys_are_padded_without_a_formatter(spark):
    rows = spark.createDataFrame([(0.0,), (-0.004,), (12.05,), (-152.789,), (179.99,), (None,), (float("nan"),)], "x double")
    for n in (1, 2, 4):
        key = names.decimal_key("x", n)
        plain = F.format_string(f"%0{n}d", F.floor((F.abs("x") - F.floor(F.abs("x"))) * 10**n).cast("long"))
        got = rows.select(key.alias("k"), plain.alias("p"))
        assert all(r.k == r.p for r in got.collect())
        assert "format_string" not in rows.select(key)._jdf.queryExecution().optimizedPlan().toString()


def test_describe(spark):
    df = spark.createDataFrame([(1, float(x), None if x == 3 else 2.0 * x) for x in range(1, 8)] + [(2, float("nan"), 5.0)], "face_id long, a double, b double")
    rows = {(r.face_id, r.variable): r for r in hits.describe_series(df, ["face_id"], ["a", "b"]).collect()}
    a = rows[1, "a"]
    assert (a["count"], a.mean, a.min, a.p25, a.p50, a.p75, a.max) == (7, 4, 1, 2.5, 4, 5.5, 7) and a.std == pytest.approx(statistics.stdev(range(1, 8)))
    assert rows[1, "b"]["count"] == 6 and (rows[2, "a"]["count"], rows[2, "a"].mean, rows[2, "b"].std) == (0, None, None)


# ---------------------------------------------------------------- extraction


@pytest.fixture
def daily(spark, tmp_path):
    path = str(tmp_path / "days")
    for day in range(4):
        one_day(spark, path, day)
    return path


def one_day(spark, path, day, add=0.0):
    rows = [(f, T0 + dt.timedelta(days=day, hours=k), float(f * 1000 + day * 24 + k + add), "x") for f in range(6) for k in range(24)]
    spark.createDataFrame(rows, "face_id int, time timestamp_ntz, zeta double, note string").coalesce(1).write.mode("overwrite").parquet(f"{path}/day{day}")


def listed(spark, path):
    return readers.list_files(spark, path, "*.parquet")


def values(ex, face):
    return [r.zeta for r in ex.series().where(F.col("face_id") == face).orderBy("time").collect()]


def test_second_run_reads_no_old_file(spark, daily, tmp_path):
    ex = extract.Extraction(spark, str(tmp_path / "out"))
    assert len(ex.run(listed(spark, daily), [1, 4])) == 4
    assert ex.run(listed(spark, daily), [1, 4]) == [] and ex.run(listed(spark, daily), []) == []
    one_day(spark, daily, 4)
    assert [f.split("/")[-2] for f in ex.run(listed(spark, daily), [1, 4])] == ["day4"]
    assert values(ex, 1) == [1000.0 + k for k in range(120)] and ex.series().count() == 240
    assert len(ex.run(listed(spark, daily), [2, 4])) == 5  # a new face in old files
    assert {r.face_id for r in ex.series().select("face_id").distinct().collect()} == {1, 2, 4} and ex.series().count() == 360


def test_changed_file_is_taken_again(spark, daily, tmp_path):
    ex = extract.Extraction(spark, str(tmp_path / "out"))
    ex.run(listed(spark, daily), [1], ["zeta"])
    one_day(spark, daily, 2, add=0.5)
    assert len(ex.run(listed(spark, daily), [1], ["zeta"])) == 1
    got = values(ex, 1)
    assert len(got) == 96 and got[48:72] == [1000.5 + k for k in range(48, 72)] and ex.series().columns == ["face_id", "time", "zeta"]


def test_run_that_died_does_not_count(spark, daily, tmp_path):
    ex = extract.Extraction(spark, str(tmp_path / "out"))
    ex.run(listed(spark, daily).where("path LIKE '%day0%'"), [1])
    name = next(d for d in os.listdir(tmp_path / "out" / "done"))
    os.rename(tmp_path / "out" / "done" / name / "_SUCCESS", tmp_path / "gone")  # died before the note was complete
    assert ex.done().count() == 0
    assert len(ex.run(listed(spark, daily), [1])) == 4
    assert values(ex, 1) == [1000.0 + k for k in range(96)]


def test_nearest_faces_and_targets(spark, daily, tmp_path):
    points = spark.createDataFrame([(f, 50.0 + f, 1.0) for f in range(6)], "face_id int, lat double, lon double")
    ex = extract.Extraction(spark, str(tmp_path / "out"))
    with pytest.raises(ValueError, match="nothing is extracted"):
        ex.series()
    assert ex.targets().count() == 0
    ex.run_nearest(points, listed(spark, daily), 52.9, 1.0, 2)
    assert {r.face_id for r in ex.series().select("face_id").distinct().collect()} == {2, 3}
    assert [(r.k, sorted(r.faces)) for r in ex.targets().collect()] == [(2, [2, 3])]


# ---------------------------------------------------------------- publishing


def tables(spark, extra=()):
    spec = spark.createDataFrame([("2.0.0", "0.0.0", "b4", 2, 8, "{location}", "s3://bucket", "/data")], manifest.SPEC)
    locations = spark.createDataFrame([("a", "1.0.0", "1h", "20070101", "000000")], manifest.LOCATIONS)
    cells = [("10_0_03_00", 1), ("10_0_05_00", 1), *extra]
    index = spark.createDataFrame(cells, "grid_id string, n long")
    points = spark.createDataFrame([(g, "a", [("1", "10.0", "0.0")]) for g, _ in cells], "grid_id string, location string, points array<struct<face_id: string, lat: string, lon: string>>")
    return spec, locations, index, points


def test_unchanged_content_keeps_its_version(spark, tmp_path):
    base = str(tmp_path / "m")
    spec, locations, index, points = tables(spark)
    assert publish.publish(spec, locations, index, points, base) == ("1.0.0", True)
    again = (spec.withColumn("manifest_version", F.lit("9.9.9")), locations, index.select("n", "grid_id").orderBy(F.desc("grid_id")), points.repartition(3))
    assert publish.publish(*again, base) == ("1.0.0", False)
    more = tables(spark, [("10_0_06_00", 1)])
    assert publish.publish(*more, base) == ("1.0.1", True)
    assert publish.load(spark, base).spec["manifest_version"] == "1.0.1" and publish.load(spark, base).index.count() == 3
    assert publish.load(spark, base, "1.0.0").index.count() == 2
    with pytest.raises(ValueError, match="not overwritten"):
        publish.publish(*tables(spark), base, "1.0.1")
    assert publish.publish(*more, base, "1.0.1") == ("1.0.1", False)
    assert publish.publish(*tables(spark), base, "1.0.10") == ("1.0.10", True) and publish.latest(spark, base) == "1.0.10"
    with pytest.raises(ValueError, match="no published manifest"):
        publish.load(spark, base, "3.0.0")


def test_publication_that_died_is_written_again(spark, tmp_path):
    base = str(tmp_path / "m")
    manifest.write(*tables(spark, [("1_1_00_00", 5)]), f"{base}/manifest_1.0.0")  # no note
    assert publish.latest(spark, base) is None
    assert publish.publish(*tables(spark), base) == ("1.0.0", True) and publish.load(spark, base).index.count() == 2


def test_digest_counts_rows_and_values(spark):
    rows = spark.createDataFrame([(1, None), (2, "x")], "a long, b string")
    same = [rows, rows.select("b", "a"), rows.orderBy(F.desc("a"))]
    other = [rows.unionByName(rows), rows.limit(1), rows.withColumn("b", F.coalesce("b", F.lit(""))), rows.withColumnRenamed("b", "c"), rows.limit(0)]
    assert len({publish.content_digest(t) for t in same}) == 1 and len({publish.content_digest(t) for t in [rows, *other]}) == 6
    assert rows.select(publish.bumped(F.lit("1.2.9")).alias("v")).first().v == publish.next_version("1.2.9") == "1.2.10"


# ---------------------------------------------------------------- tracking


def test_only_changed_files_are_verified_again(spark, daily, tmp_path):
    reference = spark.range(6).withColumnRenamed("id", "face_id")
    checks = {"steps": tracking.step_check(3600.0), "range": tracking.range_check({"zeta": (0.0, 5071.0)}), "faces": tracking.face_set_check(reference)}
    track = tracking.Tracking(spark, str(tmp_path / "track"), "1")
    assert len(track.verify(listed(spark, daily), checks)) == 4
    assert [(r.check, r.detail, r.file.split("/")[-2]) for r in track.problems(listed(spark, daily)).collect()] == [("range", "zeta: 24", "day3")]
    assert track.verify(listed(spark, daily), checks) == [] and track.unverified(listed(spark, daily)).count() == 0
    rows = [(f, T0 + dt.timedelta(hours=k), 1.0, "x") for f in (0, 1, 77) for k in (0, 1, 3)]
    spark.createDataFrame(rows, "face_id int, time timestamp_ntz, zeta double, note string").coalesce(1).write.mode("overwrite").parquet(f"{daily}/day1")
    assert [f.split("/")[-2] for f in track.verify(listed(spark, daily), checks)] == ["day1"]
    found = {(r.check, r.detail) for r in track.problems(listed(spark, daily)).where("file LIKE '%day1%'").collect()}
    assert found == {("steps", "3 series, first step 7200.0"), ("faces", "4 missing, 1 strange")}
    stricter = tracking.Tracking(spark, str(tmp_path / "track"), "2")
    assert len(stricter.verify(listed(spark, daily), {"range": tracking.range_check({"zeta": (0.0, 10.0)})})) == 4


def test_leftover_batches_are_refused(spark):
    of = lambda *ks: spark.createDataFrame([(k,) for k in ks], "batch long")
    tracking.refuse_leftovers(of(0, 1, 2, 2), 25, 10)
    with pytest.raises(ValueError, match=r"0 are missing; left over from another run: \[3, 4\]"):
        tracking.refuse_leftovers(of(0, 1, 2, 3, 4), 25, 10)
    with pytest.raises(ValueError, match="1 are missing"):
        tracking.refuse_leftovers(of(0, 2), 25, 10)
