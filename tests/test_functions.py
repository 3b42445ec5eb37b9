import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from halocline.functions import depth, flow, geo, names, styling


def one(spark, *cols):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


@pytest.mark.parametrize("u, v, expected", [(1, 0, 90), (1, 1, 45), (0, 1, 0), (-1, 1, 315), (-1, 0, 270), (-1, -1, 225), (0, -1, 180), (1, -1, 135), (0, 0, None), (0.006, 0.008, None)])
def test_directions(spark, u, v, expected):
    (got,) = one(spark, flow.to_direction(F.lit(float(u)), F.lit(float(v))))
    assert got == expected or got == pytest.approx(expected)


def test_flow(spark):
    speed, power, back, ratio, nan = one(spark, flow.speed(F.lit(3.0), F.lit(4.0)), flow.power_density(F.lit(2.0)), flow.from_direction(F.lit(270.0)), flow.max_to_mean_ratio(F.lit(1.0), F.lit(0.0)), flow.null_if_nan(F.lit(float("nan"))))
    assert (speed, power, back, ratio, nan) == (5.0, 4100.0, 90.0, None, None)
    rows = spark.createDataFrame([(350.0,), (10.0,)], "d double")
    assert rows.agg(flow.circular_mean("d")).first()[0] % 360 == pytest.approx(0, abs=1e-9)


def test_depth(spark):
    table = [r.sigma for r in depth.sigma_table(spark).orderBy("sigma_layer").collect()]
    assert table == pytest.approx([-0.05 - 0.1 * i for i in range(10)])
    levels, centres = one(spark, depth.sigma_levels(), depth.centres_of(depth.sigma_levels()))
    assert levels == pytest.approx([-0.1 * i for i in range(11)]) and centres == pytest.approx(table)
    (area,) = one(spark, depth.triangle_area([(F.lit(0.0), F.lit(0.0)), (F.lit(0.0), F.lit(0.01)), (F.lit(0.01), F.lit(0.0))]))
    assert area == pytest.approx(0.5 * (math.radians(0.01) * 6_371_000) ** 2, rel=1e-6)


def test_longitudes(spark):
    got = one(spark, *[geo.normalize_longitude(F.lit(x)) for x in (180.0, -180.0, 190.0, 540.0, 0.0)])
    assert got == (-180.0, -180.0, -170.0, -180.0, 0.0)
    flag, *un = one(spark, geo.crosses_dateline([F.lit(179.9995), F.lit(-179.9995), F.lit(179.999)]), *geo.unwrap_longitudes([F.lit(179.9995), F.lit(-179.9995), F.lit(179.999)]))
    assert flag and un == pytest.approx([179.9995, 180.0005, 179.999])
    (line,) = one(spark, geo.line_crosses_dateline(F.array(F.struct(F.lit(170.0).alias("lon")), F.struct(F.lit(-175.0).alias("lon")))))
    assert line


def test_geodesic():
    got = geo.geodesic_metres(*map(np.array, ([0.0, -37.95103342, 0.0, 50.0], [0.0, 144.42486789, 0.0, 5.0], [1.0, -37.65282114, 0.0, 50.0], [0.0, 143.92649553, 180.0, 5.0])))
    assert got[0] == pytest.approx(110574.389, abs=0.01)
    assert got[1] == pytest.approx(54972.271, abs=0.01)
    assert got[2] > 19_900_000 and got[3] == 0


def test_utm(spark):
    lat, lon = one(spark, *geo.utm_inverse(F.lit(500_000.0), F.lit(4_982_950.4), 19))
    assert lat == pytest.approx(45.0, abs=1e-5) and lon == pytest.approx(-69.0)
    lat, lon = one(spark, *geo.utm_inverse(F.lit(630084.0), F.lit(4833438.5), 17))
    assert lat == pytest.approx(43.642567, abs=2e-5) and lon == pytest.approx(-79.387139, abs=2e-5)
    assert one(spark, geo.utm_zone(F.lit(60.0), F.lit(5.0)), geo.utm_zone(F.lit(75.0), F.lit(10.0)), geo.utm_zone(F.lit(0.0), F.lit(179.9))) == (32, 33, 60)


def test_triangles_and_rings(spark):
    inside = lambda y, x, c: one(spark, geo.point_in_triangle(F.lit(y), F.lit(x), [(F.lit(a), F.lit(b)) for a, b in c]))[0]
    tri = [(0.0, 0.0), (0.0, 1.0), (1.0, 0.0)]
    assert inside(0.2, 0.2, tri) and inside(0.0, 0.5, tri) and not inside(0.6, 0.6, tri)
    assert not inside(0.0, 0.0, [(0.0, 0.0), (0.0, 0.0), (1.0, 1.0)])
    assert inside(0.0, 180.0, [(-1.0, 179.0), (-1.0, -179.0), (1.0, 180.0)])
    ring = F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in ((0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0))])
    assert one(spark, geo.point_in_ring(F.lit(0.5), F.lit(2.0), ring), geo.point_in_ring(F.lit(3.0), F.lit(2.0), ring)) == (True, False)


def test_names(spark):
    got = one(spark, names.partition_path(F.lit(59.1234567), F.lit(-152.7890123)), names.degree_key(F.lit(-0.004)), names.decimal_key(F.lit(-0.004)), names.face_label(F.lit(42)))
    assert got == ("lat_deg=59/lon_deg=-152/lat_dec=12/lon_dec=78", 0, "00", "00000042")
    uri = names.full_year_uri("s3://b/", F.lit("loc"), F.lit(7), F.lit(59.1234567), F.lit(-152.7890123))
    f, p, d = one(spark, names.parse_point_file(uri), names.parse_partition_path(uri), names.parse_point_file(F.lit("x.parquet")))
    assert f.asDict() == {"face_id": 7, "lat": "59.1234567", "lon": "-152.7890123", "temporal": "1h"} and p.lon_dec == 78 and d is None
    assert one(spark, names.next_patch(F.lit("v1.0.9")), names.semver(F.lit("1.0.10")) > names.semver(F.lit("1.0.9")), names.semver(F.lit("x"))) == ("1.0.10", True, None)
    ring, html, mjd, batch = one(spark, names.parse_wkt_polygon(F.lit("POLYGON ((1 2, 3 4, 1 2))")), names.clean_html(F.lit("<i>a</i>&nbsp;&amp;  b")), names.hsds_time(names.from_mjd(F.lit(55350.5))), names.parse_face_batch(F.lit("x.batch_3_faces_10_19.nc")))
    assert [tuple(x) for x in ring] == [(1.0, 2.0), (3.0, 4.0), (1.0, 2.0)] and html == "a & b" and mjd == "2010-06-03 12:00:00+00:00" and tuple(batch) == (3, 10, 19)
    assert one(spark, names.human_size(F.lit(1536)), names.human_time(F.lit(3725)), names.render_template(F.lit("{a} of {b}"), {"a": F.lit("x")})) == ("1.50 KB", "1h 2m", None)
    stamp = F.lit("2010-06-03 01:02:03").cast("timestamp")
    parsed = one(spark, names.parse_data_file(names.data_file_name(F.lit("AK"), "tide", "b1", stamp, "1h", "1.2.3", "nc")))[0]
    assert (parsed.location, parsed.level, str(parsed.date), parsed.version, parsed.ext) == ("AK", "b1", "2010-06-03", "1.2.3", "nc")


def test_etag(spark):
    import hashlib

    data = bytes(range(250)) * 10
    parts = [hashlib.md5(data[i : i + 1000]).digest() for i in range(0, 2500, 1000)]
    df = spark.createDataFrame([(data,), (b"x",), (b"",)], "c binary").select(names.multipart_etag("c", 1000))
    assert [r[0] for r in df.collect()] == [hashlib.md5(b"".join(parts)).hexdigest() + "-3", hashlib.md5(b"x").hexdigest(), hashlib.md5(b"").hexdigest()]


def test_styling(spark):
    got = one(spark, *[styling.resolution_class(F.lit(x)) for x in (0.0, 49.9, 50.0, 500.0, 1e6)], styling.level_of(F.lit(5.0), 0, 5, 10), styling.level_of(F.lit(-1.0), 0, 5, 10), styling.level_of(F.lit(4.99), 0, 5, 10))
    assert got == ("small", "small", "medium", "large", "large", 10, 0, 9)
    ramp = [(0, 0, 0), (255, 255, 255)]
    assert styling.palette(ramp, 3, at_centres=False) == ["#000000", "#808080", "#ffffff"] and styling.palette(ramp, 2) == ["#404040", "#bfbfbf"]
    assert one(spark, styling.fill_color(F.lit(9.0), 0, 10, 2, ramp), styling.unit_of(F.lit("mean_speed"))) == ("#bfbfbf", "m/s")
