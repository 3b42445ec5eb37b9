"""Provenance and attributes."""

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from halocline.operators import provenance
from halocline.sources import attributes


def links(spark, *pairs):
    return spark.createDataFrame(list(pairs), "file string, input string")


def test_ancestors_by_the_shortest_chain(spark):
    inputs = links(spark, ("d", "c"), ("d", "a"), ("c", "b"), ("b", "a"), ("b", "a"), ("x", None), (None, "a"), ("s", "s"), ("p", "q"), ("q", "p"))
    got = {(r.file, r.ancestor, r.steps) for r in provenance.ancestors(inputs).collect()}
    assert got == {("d", "c", 1), ("d", "a", 1), ("d", "b", 2), ("c", "b", 1), ("c", "a", 2), ("b", "a", 1), ("s", "s", 1), ("p", "q", 1), ("q", "p", 1), ("p", "p", 2), ("q", "q", 2)}
    assert {(r.file, r.root, r.place) for r in provenance.roots(inputs.where("file IN ('b', 'c', 'd')")).collect()} == {("d", "a", 1), ("c", "a", 1), ("b", "a", 1)}
    assert provenance.ancestors(inputs.limit(0)).count() == 0


def test_long_chains(spark):
    chain = links(spark, *[(f"f{k}", f"f{k - 1}") for k in range(1, 6)])
    assert provenance.ancestors(chain, 5).count() == 15
    with pytest.raises(ValueError, match="more than 4 steps"):
        provenance.ancestors(chain, 4)


def test_history_is_nested_by_level_and_survives_text(spark):
    inputs = links(spark, ("b1/z", "a1/y1"), ("b1/z", "a1/y2"), ("a1/y1", "00/x1"), ("a1/y2", "00/x1"), ("a1/y2", "00/gone"))
    files = spark.createDataFrame([("b1/z", "b1", "hz"), ("a1/y1", "a1", "h1"), ("a1/y2", "a1", None), ("00/x1", "00", "hx")], "file string, level string, hash string")
    history = provenance.input_history(inputs, files)
    rows = {r.file: r.history for r in history.collect()}
    shape = lambda h: [(x.level, [(f.path, f.filename, f.hash.algorithm, f.hash.value) for f in x.files]) for x in h]
    sha = "SHA-256"
    assert shape(rows["b1/z"]) == [("00", [("00/x1", "x1", sha, "hx")]), ("a1", [("a1/y1", "y1", sha, "h1"), ("a1/y2", "y2", sha, None)]), ("unknown", [("00/gone", "gone", sha, None)])]
    assert rows["00/x1"] == []
    back = history.select("file", F.col("history").alias("h"), provenance.history_json().alias("t")).select("file", "h", provenance.parse_history("t").alias("p"))
    assert all(shape(r.h) == shape(r.p) for r in back.collect())
    now = files.withColumn("hash", F.when(F.col("file") == "a1/y1", "other").otherwise(F.col("hash"))).where("file <> '00/x1'")
    changed = {(r.file, r.path, r.recorded, r.current) for r in provenance.changed_inputs(history, now).collect()}
    assert {c for c in changed if c[0] == "b1/z"} == {("b1/z", "a1/y1", "h1", "other"), ("b1/z", "00/x1", "hx", None)}


def facts(spark, lons=(179.0, -179.0)):
    rows = [(k, float(10 + k), float(x), dt.datetime(2007, 1, 1 + k), 0.5) for k, x in enumerate(lons)]
    return spark.createDataFrame(rows, "face_id long, lat double, lon double, time timestamp_ntz, zeta double")


def test_attributes_go_through_files_and_plans(spark, tmp_path):
    df = attributes.with_attributes(facts(spark), {"zeta": {"units": "m", "valid_range": [-5, 5]}, "face_id": {"long_name": "face"}}, {"title": "t", "version": 2})
    df.write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    assert attributes.attributes_of(read) == ({"title": "t", "version": 2}, {"zeta": {"units": "m", "valid_range": [-5, 5]}, "face_id": {"long_name": "face"}})
    footer = pq.read_schema(next((tmp_path / "t").glob("*.parquet"))).metadata
    assert b'"units":"m"' in footer[b"org.apache.spark.sql.parquet.row.metadata"]
    kept = read.where("lat > 0").join(read.select("face_id", "lat").withColumnRenamed("lat", "y"), "face_id").select("face_id", "zeta", "y")
    assert attributes.attributes_of(kept)[1]["zeta"]["units"] == "m"
    derived = attributes.carry(read.select((F.col("zeta") * 2).alias("level"), F.abs("zeta").alias("zeta")), read, {"level": "zeta"})
    assert attributes.attributes_of(derived) == ({"title": "t", "version": 2}, {"level": {"units": "m", "valid_range": [-5, 5]}, "zeta": {"units": "m", "valid_range": [-5, 5]}})
    assert derived.collect() == read.selectExpr("zeta * 2 AS level", "abs(zeta) AS zeta").collect()


def test_merging_finding_and_comparing(spark):
    df = attributes.with_attributes(facts(spark), {"zeta": {"units": "m", "note": "x"}}, {"title": "t", "gone": 1})
    again = attributes.with_attributes(df, {"zeta": {"units": "cm", "note": None, "standard_name": "level"}}, {"gone": None})
    assert attributes.attributes_of(again) == ({"title": "t"}, {"zeta": {"units": "cm", "standard_name": "level"}})
    assert attributes.find_variables(again, "standard_name", "level") == ["zeta"] and attributes.find_variables(again, "units", "m") == []
    changes = {(r.variable, r.what, r.before, r.after) for r in attributes.structure_changes(df, again.drop("lat")).collect()}
    assert changes == {("", "attribute gone", "1", None), ("zeta", "attribute note", "x", None), ("zeta", "attribute units", "m", "cm"), ("zeta", "attribute standard_name", None, "level"), ("lat", "type", "double", None)}
    assert [(r.variable, r.type, r.n_attributes) for r in attributes.structure(again).where("position IN (0, 4)").orderBy("position").collect()] == [("face_id", "bigint", 0), ("zeta", "double", 2)]
    assert attributes.missing_attributes(again, {"zeta": {"units": "m", "standard_name": "level"}, "": {"title": "t", "source": "model"}, "u": {"a": 1}}) == [("zeta", "units", "cm", "m"), ("", "source", None, "model"), ("u", "a", None, "1")]
    with pytest.raises(ValueError, match="no such columns"):
        attributes.with_attributes(df, {"nope": {"a": 1}})
    assert attributes.attribute_table(facts(spark)).count() == 0


def test_bounds_over_the_date_line(spark):
    west = attributes.bounds(facts(spark, (179.0, -179.0, -178.5)), step_s=3600.0)
    assert (west["geospatial_lon_min"], west["geospatial_lon_max"]) == (179.0, 181.5)
    assert (west["time_coverage_start"], west["time_coverage_end"], west["time_coverage_duration_s"], west["time_coverage_resolution_s"]) == ("2007-01-01T00:00:00Z", "2007-01-03T00:00:00Z", 172800.0, 3600.0)
    plain = attributes.bounds(facts(spark, (-10.0, 20.0)), time=None, depth="zeta")
    assert (plain["geospatial_lon_min"], plain["geospatial_lon_max"], plain["geospatial_vertical_max"]) == (-10.0, 20.0, 0.5)
    assert attributes.bounds(facts(spark).limit(0)) == {}
    assert set(attributes.for_parts(west)) == {"geospatial_lat_units", "geospatial_lon_units", "time_coverage_start", "time_coverage_end", "time_coverage_duration_s", "time_coverage_resolution_s"}


def test_a_history_is_shuffled_by_file_only(spark):
    inputs = spark.createDataFrame([("a1/x.nc", "00/y.nc")], "file string, input string")
    files = spark.createDataFrame([("a1/x.nc", "a1", "h1"), ("00/y.nc", "00", "h0")], "file string, level string, hash string")
    history = provenance.input_history(inputs, files)
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(file#" in plan and not any("hashpartitioning(file#" in n and "level#" in n.split("]")[0] for n in plan.split("\n") if "Exchange" in n)
    assert {r.file: [h.files[0].filename for h in r.history] for r in history.collect()} == {"a1/x.nc": ["y.nc"], "00/y.nc": []}


def test_a_history_sends_each_hash_once_as_bytes(spark):
    """Names in files twice, hashes that are no lower-case hex, cycles, and files behind others by chains of two lengths."""
    inputs = links(spark, ("c/3", "b/2"), ("c/3", "a/1"), ("b/2", "a/1"), ("b/2", "a/0"), ("b/2", "a/0"), ("p/1", "q/1"), ("q/1", "p/1"), ("gone/1", "a/1"), ("b/2", None))
    hashes = {"c/3": "0A", "b/2": "abc", "a/1": "00ff", "a/0": "", "p/1": "zz", "q/1": "12"}
    files = spark.createDataFrame([(f, f[0], h) for f, h in hashes.items()] + [("a/1", "a", "00fe"), ("c/3", "c", "0A"), (None, "z", "1")], "file string, level string, hash string")
    history = provenance.input_history(inputs, files)
    got = sorted((r.file or "", [(h.level, [(f.path, f.hash.value) for f in h.files]) for h in r.history]) for r in history.collect())
    first = ("a", [("a/0", ""), ("a/1", "00fe"), ("a/1", "00ff")])
    third = ("c/3", [first, ("b", [("b/2", "abc")])])
    ring = [("p", [("p/1", "zz")]), ("q", [("q/1", "12")])]
    assert got == [("", []), ("a/0", []), ("a/1", []), ("a/1", []), ("b/2", [first]), third, third, ("p/1", ring), ("q/1", ring)]
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(file#" in plan and "unhex" in plan


def test_a_history_of_too_many_steps(spark):
    chain = links(spark, *[(f"f{k}", f"f{k - 1}") for k in range(1, 6)])
    files = spark.createDataFrame([(f"f{k}", "f", "00") for k in range(6)], "file string, level string, hash string")
    assert {r.file: len(r.history[0].files) if r.history else 0 for r in provenance.input_history(chain, files, 5).collect()} == {f"f{k}": k for k in range(6)}
    with pytest.raises(ValueError, match="more than 4 steps"):
        provenance.input_history(chain, files, 4)
