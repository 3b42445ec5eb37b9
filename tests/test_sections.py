"""Sections against interpolation by hand."""

import numpy as np
import pytest

from halocline.operators import sections

CORNERS = [("la0", "lo0"), ("la1", "lo1"), ("la2", "lo2")]
COLUMNS = "face_id long, " + ", ".join(f"la{i} double, lo{i} double, h{i} double, d{i} array<double>, u{i} array<double>, v{i} array<double>" for i in range(3))


def three(c):
    return [f"{c}{i}" for i in range(3)]


def corner(lat, lon):
    """A field that is linear in place and depth: u = lat + depth, v = lon - depth; the floor lies at 10 + lon."""
    floor = 10.0 + lon
    depths = [floor * s for s in (0.1, 0.35, 0.9)]
    return [float(lat), float(lon), floor, depths, [lat + d for d in depths], [lon - d for d in depths]]


def test_linear_field_comes_back(spark):
    faces = [(1, *corner(0, 0), *corner(0, 2), *corner(2, 0)), (2, *corner(0, 2), *corner(2, 2), *corner(2, 0))]
    out = sections.cross_section(spark.createDataFrame(faces, COLUMNS), (0.5, 0.1), (0.5, 2.5), 13, 7, CORNERS, three("h"), three("d"), three("u"), three("v")).collect()
    assert len(out) == 13 * 7
    deepest = max(10 + r.lon for r in out if r.lon <= 2)
    for r in out:
        assert r.depth_m == pytest.approx(deepest * r.level / 6)
        if r.lon > 2.0000001:
            assert (r.face_id, r.along, r.speed) == (None, None, None)
            continue
        floor = 10 + r.lon
        assert r.floor_m == pytest.approx(floor) and r.face_id == (1 if r.lon <= 1.5 + 1e-9 else 2)
        if r.depth_m > floor:
            assert r.along is None
            continue
        d = min(max(r.depth_m, 0.1 * floor), 0.9 * floor)  # between the first and the last layer
        assert (r.along, r.across) == pytest.approx((r.lat + d, r.lon - d))  # the line leads east
        assert r.speed == pytest.approx(np.hypot(r.lat + d, r.lon - d))


def test_flow_along_and_across(spark):
    still = lambda lat, lon: [float(lat), float(lon), 10.0, [1.0, 9.0], [3.0, 3.0], [4.0, 4.0]]
    faces = spark.createDataFrame([(1, *still(0, 0), *still(0, 4), *still(4, 0))], COLUMNS)
    north = sections.cross_section(faces, (0.5, 0.5), (2.0, 0.5), 3, 2, CORNERS, three("h"), three("d"), three("u"), three("v")).first()
    assert (north.along, north.across, north.speed) == pytest.approx((4, -3, 5))
    one = sections.cross_section(faces, (0.5, 0.5), (0.5, 0.6), 2, 1, CORNERS, three("h"), three("d"), three("u"), three("v")).collect()
    assert [(r.level, r.depth_m, r.along, r.across) for r in one] == [(0, 0.0, pytest.approx(3), pytest.approx(4))] * 2
    none = sections.cross_section(faces.limit(0), (0.5, 0.5), (2.0, 0.5), 3, 2, CORNERS, three("h"), three("d"), three("u"), three("v"))
    assert [r.along for r in none.collect()] == [None] * 6


def test_matrix_cells_and_shore(spark):
    """Faces every 1.11 km to the east and west, then a gap."""
    at = [*range(-3, 6), 60, 61]
    rows = [(k, 0.0 - 0.004, 0.01 * k, 0.0 + 0.004, 0.01 * k, 0.0, 0.01 * k + 0.003, [1.0, 2.0, 4.0], [10.0 * k, 10.0 * k + 1, 10.0 * k + 2]) for k in at]
    faces = spark.createDataFrame(rows, "face_id long, la0 double, lo0 double, la1 double, lo1 double, la2 double, lo2 double, d array<double>, v array<double>")
    out = sections.transect_matrix(faces, (0.0, 0.0), 90.0, 100.0, CORNERS, "d", "v", shore_deviations=2.0).orderBy("position", "sigma_layer").collect()
    assert [r.face_id for r in out if r.sigma_layer == 0] == list(range(-3, 6))
    first = out[0]
    assert (first.depth_m, first.top_m, first.bottom_m, first.value) == (1.0, 0.5, 1.5, -30.0)
    assert [(r.top_m, r.bottom_m) for r in out[:3]] == [(0.5, 1.5), (1.5, 3.0), (3.0, 5.0)]
    cells = [r for r in out if r.sigma_layer == 1]
    assert all(a.to_km == pytest.approx(b.from_km) for a, b in zip(cells, cells[1:], strict=False))
    assert all(r.to_km - r.from_km == pytest.approx(1.11) for r in cells) and [r.position for r in cells] == list(range(1, 10))
    ahead = sections.transect_matrix(faces, (0.0, 0.0), 90.0, 100.0, CORNERS, "d", "v", both_ways=False, shore_deviations=None)
    assert sorted({r.face_id for r in ahead.collect()}) == [*range(0, 6), 60, 61]
    alone = sections.transect_matrix(faces.where("face_id = 2"), (0.0, 0.0), 90.0, 100.0, CORNERS, "d", "v").first()
    assert alone.to_km - alone.from_km == pytest.approx(1.0)


def test_well_known_binary(spark, tmp_path):
    import struct

    from halocline.sources import writers

    ring = [(0.0, 1.5), (2.0, 1.5), (2.0, 3.0), (0.0, 1.5)]
    df = spark.createDataFrame([(1, [{"lon": x, "lat": y} for x, y in ring]), (2, None)], "id long, ring array<struct<lon: double, lat: double>>")
    writers.write_wkb(df, "ring", str(tmp_path / "g"))
    rows = {r.id: r.geometry for r in spark.read.parquet(str(tmp_path / "g")).collect()}
    assert rows[2] is None and struct.unpack("<BIII8d", bytes(rows[1])) == (1, 3, 1, 4, *[v for p in ring for v in p])


def test_faces_of_overlapping_squares_count_once(spark):
    from halocline.operators import spatial

    faces = spark.createDataFrame([(k, 0.0, 0.001 * k, float(k)) for k in range(10)], "face_id long, lat double, lon double, p double")
    spots = spark.createDataFrame([(1, 0.0, 0.004), (2, 0.0, 0.007), (3, 60.0, 60.0), (4, None, 1.0)], "rank int, lat double, lon double")
    side = 0.005 * 111_000  # two and a half thousandths to either side
    both = {r.rank: r.n_faces for r in spatial.neighbourhoods(faces, spots, "p", side).collect()}
    assert both == {1: 5, 2: 5}
    once = {r["rank"]: (r.n_faces, r.max_value) for r in spatial.neighbourhoods(faces, spots, "p", side, exclusive=True).collect()}
    assert once == {1: (5, 6.0), 2: (3, 9.0), None: (8, 9.0)}


def test_polygons_within_the_tolerance_are_no_change(spark):
    from halocline.operators import checks

    old = "POLYGON ((1.0 2.0, 3.0 4.0, 1.0 2.0))"
    rows = [(1, old, "POLYGON ((1.00005 2.0, 3.0 3.99999, 1.0 2.0))"), (2, old, "POLYGON ((1.1 2.0, 3.0 4.0, 1.0 2.0))"), (3, old, "POLYGON ((1.0 2.0, 3.0 4.0))"), (4, old, "none"), (5, old, None)]
    side = lambda k: spark.createDataFrame([(r[0], {"geospatial_bounds": r[k], "title": "t"}) for r in rows], "id int, attrs map<string, string>")
    assert sorted(r.id for r in checks.attribute_changes(side(1), side(2), ["id"], "attrs", []).collect()) == [2, 3, 4, 5]


def test_exact_percentiles_over_many_tasks(spark):
    from halocline.operators import regions

    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=999), 1)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert regions.exact_percentiles(df, "x", (0.0, 0.123, 0.5, 0.99, 1.0)) == pytest.approx(np.quantile(x, (0.0, 0.123, 0.5, 0.99, 1.0)).tolist())
        assert regions.exact_percentiles(df.where("x IS NULL"), "x", (0.5,)) == [None]
        assert regions.power_statistics(df.limit(0), "x").first().p95 is None
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
