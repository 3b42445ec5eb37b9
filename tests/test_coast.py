"""Coasts, large rings over the date line, jurisdictions and time zones against plain geometry."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from halocline.operators import coast

LINES = "line array<struct<lon: double, lat: double>>"


def turned(d):
    return (d + 180) % 360 - 180


def plain_nearest(point, lines):
    """(degrees, lat, lon) by every segment."""
    lat, lon = point
    best = None
    for line in lines:
        for (x1, y1), (x2, y2) in zip(line, line[1:] or line, strict=False) if len(line) > 1 else [(line[0], line[0])]:
            dx, dy = turned(x2 - x1), y2 - y1
            ax, ay = turned(x1 + dx / 2 - lon) - dx / 2, y1 - lat
            t = min(max(-(ax * dx + ay * dy) / (dx * dx + dy * dy), 0), 1) if dx or dy else 0
            hit = (math.hypot(ax + t * dx, ay + t * dy), lat + ay + t * dy, turned(lon + ax + t * dx))
            best = min(best or hit, hit)
    return best


def world():
    rnd = random.Random(9)
    lines = [[(179.5, 51.0), (-179.7, 52.0), (-178.0, 51.5)], [(10.0, 10.0)], [(-5.0, 40.0), (5.0, 40.0)], [(20.0, -30.0), (20.0, -20.0)], [(100.0, 89.0), (120.0, 89.5)]]
    for _ in range(12):
        x, y = rnd.uniform(-180, 180), rnd.uniform(-70, 70)
        lines.append([(turned(x + rnd.uniform(-3, 3)), y + rnd.uniform(-3, 3)) for _ in range(rnd.randrange(1, 9))])
    points = [(51.5, 179.99), (51.5, -179.99), (51.6, 179.0), (10.0, 10.0), (10.01, 10.0), (40.3, 0.0), (-25.0, 20.2), (-25.0, 180.0), (90.0, 0.0), (-90.0, 5.0), (0.0, -180.0)]
    points += [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(60)]
    return lines, points


@pytest.mark.parametrize(("radii", "units"), [(coast.RADII_KM, "nautical_miles"), (coast.DATE_LINE_RADII_KM, "km"), ((700.0,), "km")])
def test_distance_to_coast(spark, radii, units):
    lines, points = world()
    shore = spark.createDataFrame([([{"lon": x, "lat": y} for x, y in line], str(k)) for k, line in enumerate(lines)] + [([], "none"), (None, "null")], f"{LINES}, name string")
    faces = spark.createDataFrame([(k, *p, 7) for k, p in enumerate(points)] + [(500, None, 1.0, 7), (501, *points[0], 7), (501, *points[0], 7)], "face_id long, lat double, lon double, hit int")
    rows = coast.distance_to_coast(faces, shore, radii_km=radii, units=units, label="name").collect()
    assert len(rows) == len(points) + 3
    metres, land = coast.UNITS[units]
    for r in rows:
        if r.lat is None:
            assert r.distance_to_shore is None
            continue
        degrees, lat, lon = plain_nearest((r.lat, r.lon), lines)
        away = degrees * coast.METRES_PER_DEGREE
        if away > radii[-1] * 1000:
            assert (r.distance_to_shore, r.closest_shore_lat, r.closest_label) == (None, None, None)
        elif away / metres < land:
            assert (r.distance_to_shore, r.closest_shore_lat, r.closest_shore_lon) == (0, r.lat, r.lon)
        else:
            assert r.distance_to_shore == pytest.approx(away / metres, abs=1e-9)
            assert (r.closest_shore_lat, turned(r.closest_shore_lon - lon)) == pytest.approx((lat, 0), abs=1e-9)
            assert plain_nearest((r.lat, r.lon), [lines[int(r.closest_label)]])[0] == pytest.approx(degrees)


def test_beyond_the_last_radius_is_an_error_when_strict(spark):
    shore = spark.createDataFrame([([{"lon": 0.0, "lat": 0.0}],)], LINES)
    faces = spark.createDataFrame([(1, 0.5, 0.5), (2, 60.0, 60.0)], "face_id long, lat double, lon double")
    with pytest.raises(ValueError, match="1 positions"):
        coast.distance_to_coast(faces, shore, radii_km=(10.0, 100.0), strict=True)
    assert coast.distance_to_coast(faces.limit(0), shore, strict=True).count() == 0
    assert [r.distance_to_shore for r in coast.distance_to_coast(faces, shore.limit(0)).collect()] == [None, None]


def test_the_index_of_a_coast_is_never_broadcast(spark):
    lines = spark.range(2).selectExpr("transform(sequence(0, 399), k -> named_struct('lon', k / 10D, 'lat', k / 20D)) AS line")
    segs = coast.segments(lines)
    at = spark.range(1).selectExpr("id + 1D AS lat", "id + 2D AS lon")
    for radius in coast.RADII_KM:
        plan = coast.nearest_within(at, segs, radius)._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert segs.count() == 399  # lines that run together count once


def inside(point, ring):
    """Even-odd rule on an unwrapped ring, for every turn of the globe."""
    lat, lon = point
    for turn in (-720, -360, 0, 360, 720):
        hits = 0
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True):
            if (y1 > lat) != (y2 > lat) and lon + turn < (x2 - x1) * (lat - y1) / (y2 - y1) + x1:
                hits += 1
        if hits % 2:
            return True
    return False


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.floats(-30, 30), st.floats(-40, 40)), min_size=3, max_size=12), st.sampled_from([0.5, 1.0, 3.0, 10.0]), st.floats(-180, 180), st.integers(0, 2**30))
def test_parts_of_a_ring_make_up_the_ring(offsets, size, middle, seed):
    ring = np.array([(turned(middle + dx), dy) for dx, dy in offsets])
    whole = coast.unwrapped(ring)
    parts = {}
    for y, x, part in coast.cell_parts(ring, size):
        parts.setdefault((y, x), []).append(part)
    rnd = random.Random(seed)
    for _ in range(40):
        lat, lon = rnd.uniform(-42, 42), turned(middle + rnd.uniform(-35, 35))
        cell = (math.floor(lat / size), math.floor((lon + 180) / size) % round(360 / size))
        found = any(inside((lat, lon), p.tolist()) for p in parts.get(cell, []))
        assert found == inside((lat, lon), [tuple(p) for p in whole])


def test_ring_of_many_corners_is_not_copied_into_every_cell():
    turn = np.linspace(0, 2 * np.pi, 100_000, endpoint=False)
    ring = np.column_stack((20 * np.cos(turn), 20 * np.sin(turn)))
    parts = list(coast.cell_parts(ring, 1.0))
    assert len(parts) > 1200 and sum(len(p[2]) for p in parts) < 110_000


def test_ring_around_the_pole_and_around_the_globe():
    polar = np.array([(-170.0, 70.0), (-60.0, 65.0), (60.0, 72.0), (170.0, 68.0)])
    parts = {(y, x): p for y, x, p in coast.cell_parts(polar, 10.0)}
    assert {x for y, x in parts if y == 8} == set(range(36))  # all around the pole
    box = np.array([(-180.0, -5.0), (180.0, -5.0), (180.0, 5.0), (-180.0, 5.0), (-180.0, -5.0)])
    assert {(y, x) for y, x, _ in coast.cell_parts(box, 10.0)} == {(y, x) for y in (-1, 0) for x in range(36)}


def boundary(source, ring, **kind):
    row = {"source": source, "stateName": None, "TS": None, "EEZ": None, "REGION": None, "CZMADomain": None} | kind
    return (*row.values(), [{"lon": float(x), "lat": float(y)} for x, y in ring])


BOUNDARY = "source string, stateName string, TS int, EEZ int, REGION string, CZMADomain string, ring array<struct<lon: double, lat: double>>"


def test_labels_on_both_sides_of_the_date_line(spark):
    square = lambda x, y, w: [(turned(x - w), y - w), (turned(x + w), y - w), (turned(x + w), y + w), (turned(x - w), y + w)]
    rows = [
        boundary("state", square(180, 52, 1), stateName="Alaska"),
        boundary("sea", square(180, 52, 2), TS=1, EEZ=0, REGION="Atlantic Coast"),
        boundary("sea", square(180, 52, 4), TS=0, EEZ=1, REGION="Alaska"),
        boundary("czma", square(0, 0, 2), CZMADomain="federal consistency by state"),
        boundary("sea", square(0, 10, 2), TS=0, EEZ=0, REGION="Alaska"),
    ]
    at = {1: (52, 179.5), 2: (52, -179.5), 3: (53.5, 178.5), 4: (53.5, -178.5), 5: (55, 177), 6: (55, -177), 7: (60, 180), 8: (0, 0), 9: (10, 0), 10: (None, None)}
    points = spark.createDataFrame([(k, *(None if v is None else float(v) for v in p)) for k, p in at.items()], "face_id long, lat double, lon double")
    bounds = spark.createDataFrame(rows, BOUNDARY)
    eez, outside = ("exclusive economic zone", "exclusive economic zone limits"), ("outside", "None")
    alaska, sea = ("Alaska state waters", "coastal states"), ("territorial sea", "territorial sea limits")
    got = lambda **s: {r.face_id: (r.jurisdiction, r.jurisdiction_source) for r in coast.label_points(points, bounds, ["face_id"], **s).collect()}
    assert got() == {1: alaska, 2: alaska, 3: outside, 4: outside, 5: eez, 6: eez, 7: outside, 8: ("exclusive economic zone", "coastal zone management areas"), 9: eez, 10: outside}
    assert got(date_line=True) == {1: alaska, 2: alaska, 3: sea, 4: sea, 5: eez, 6: eez, 7: outside, 8: outside, 9: outside, 10: outside}


def test_two_states_are_an_error(spark):
    found = spark.createDataFrame([(1, "state", "Maine", 0, 0), (1, "state", "Oregon", 0, 0), (2, "state", "Maine", 0, 0), (2, "state", "Maine", 0, 0)], "id int, source string, stateName string, TS int, EEZ int")
    with pytest.raises(Exception, match="more than one state: Maine/Oregon"):
        coast.jurisdiction(found, ["id"]).collect()
    assert {r.id: r.jurisdiction for r in coast.jurisdiction(found, ["id"], two_states="join").collect()} == {1: "Maine/Oregon state waters", 2: "Maine state waters"}


def test_time_zones(spark):
    square = lambda x, y, w: [{"lon": float(turned(x + a * w)), "lat": float(y + b * w)} for a, b in ((-1, -1), (1, -1), (1, 1), (-1, 1))]
    zones = spark.createDataFrame([("America/Denver", square(-110, 35, 5)), ("America/Phoenix", square(-111, 34, 1)), ("Pacific/Auckland", square(180, -40, 3)), ("Asia/Kolkata", square(78, 20, 6))], "zone string, ring array<struct<lon: double, lat: double>>")
    at = [(1, 35.0, -108.0), (2, 34.0, -111.0), (3, -41.0, 179.0), (4, -41.0, -178.0), (5, 20.0, 80.0), (6, 20.0, 92.0), (7, 85.0, 0.0), (8, None, None), (8, None, None)]
    points = spark.createDataFrame(at, "face_id long, lat double, lon double")
    rows = coast.time_zones(points, zones, day="2023-07-15").collect()
    assert {r.face_id: (r.time_zone, r.utc_offset_hours) for r in rows} == {
        1: ("America/Denver", -6), 2: ("America/Phoenix", -7), 3: ("Pacific/Auckland", 12), 4: ("Pacific/Auckland", 12),
        5: ("Asia/Kolkata", 5), 6: ("Asia/Kolkata", 5), 7: ("Etc/GMT", 0), 8: ("Etc/GMT", 0),
    }
    assert len(rows) == 9 and {r.utc_offset_hours for r in coast.time_zones(points.where("face_id = 3"), zones).collect()} == {13}


def test_equal_positions_and_rings_are_tested_once(spark, monkeypatch):
    monkeypatch.setattr(coast.gathered, "__defaults__", (3,))
    ring = "array(named_struct('lon', 0D, 'lat', 0D), named_struct('lon', 4D, 'lat', 0D), named_struct('lon', 4D, 'lat', 4D))"
    faces = spark.range(20).selectExpr("id AS face_id", "IF(id < 18, 1D, 50D) AS lat", "IF(id = 0, CAST(null AS DOUBLE), 2D) AS lon")
    rings = spark.range(7).selectExpr("id AS k", f"{ring} AS ring")
    met = coast.points_in_rings(faces, rings)
    assert met.columns == ["face_id", "lat", "lon", "k"]
    assert sorted((r.face_id, r.k) for r in met.collect()) == [(f, k) for f in range(1, 18) for k in range(7)]
    joined = [n for n in met._jdf.queryExecution().executedPlan().toString().split("\n") if "Join" in n]
    assert joined and not any("cell_y" in n and "Broadcast" in n for n in joined)
    # 18 faces in arrays of 3 and 7 rings in arrays of 3, more or less: far fewer rows than pairs
    assert 2 <= coast.gathered(rings, ["ring"], "m").count() <= 3
    areas = spark.range(2).selectExpr("'czma' AS source", "CAST(null AS STRING) AS stateName", "0 AS TS", "0 AS EEZ", "CAST(null AS STRING) AS REGION", "'partly federal consistency' AS CZMADomain", f"{ring} AS ring")
    label = lambda rows: {r.jurisdiction for r in coast.label_points(faces.where("face_id IN (2, 3)"), rows, ["face_id"]).collect()}
    assert (label(areas), label(areas.limit(1))) == ({coast.NOT_FOUND}, {coast.EEZ})  # equal areas still count as two
    plan = coast.label_points(faces, areas, ["face_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan and plan.count("copies_") > 1
