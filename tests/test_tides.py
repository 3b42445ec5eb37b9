"""Tides in ranges against whole series."""

import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from halocline.operators import tides

T0 = dt.datetime(2007, 1, 1)


def plain_peaks(x, prominence=tides.PROMINENCE_M):
    """Middles of plateaus, with the prominence by its definition."""
    out, i = [], 1
    while i < len(x) - 1:
        j = i
        while j + 1 < len(x) and x[j + 1] == x[i]:
            j += 1
        if x[i - 1] < x[i] and j + 1 < len(x) and x[j + 1] < x[i]:
            p = (i + j) // 2
            left = next((k for k in range(p, -1, -1) if x[k] > x[p]), -1)
            right = next((k for k in range(p, len(x)) if x[k] > x[p]), len(x))
            if x[p] - max(min(x[left + 1 : p + 1]), min(x[p:right])) >= prominence:
                out.append(p)
        i = j + 1
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 12).map(lambda k: k / 50), max_size=40))
def test_what_a_part_tells_holds_for_the_whole(values):
    x = np.array(values)
    whole = plain_peaks(values)
    for a in range(0, len(x), 7):
        part = x[a : a + 15]
        found, open_at, left, right = tides.judged(part, tides.PROMINENCE_M)
        assert set(found + a) <= set(whole)
        runs_open = {k for i in open_at for k in range(len(part)) if np.ptp(part[min(i, k) : max(i, k) + 1]) == 0}
        assert {p - a for p in whole if a <= p < a + len(part)} <= set(found) | runs_open
        assert len(open_at) == len(left) == len(right)


def series_of(x, step_min=60.0, face=1):
    return [(face, T0 + dt.timedelta(minutes=step_min * k), None if v is None else float(v)) for k, v in enumerate(x)]


SCHEMA = "face_id long, time timestamp_ntz, zeta double"


def expected_points(rows):
    out = set()
    for face in {r[0] for r in rows}:
        own = sorted(((t, z) for f, t, z in rows if f == face and z is not None and not math.isnan(z)))
        x = [z for _, z in own]
        out |= {(face, "high", own[p][0], x[p]) for p in plain_peaks(x)} | {(face, "low", own[p][0], x[p]) for p in plain_peaks([-v for v in x])}
    return out


def mixed_rows():
    rng = np.random.default_rng(4)
    hours = np.arange(24 * 40)
    rows = series_of(np.sin(2 * np.pi * hours / 12.42) + 0.3 * np.sin(2 * np.pi * hours / 25.8) + 0.02 * rng.normal(size=len(hours)), face=1)
    rows += series_of(np.full(900, 1.5), face=2) + series_of(np.round(rng.normal(size=700) * 0.03, 2), face=3)
    rows += series_of(0.5 * np.sin(2 * np.pi * hours / 600), face=4)  # slower than any overlap
    rows += series_of([0, 1, *[1] * 300, 0, 0, 2, None, float("nan"), 0], face=5) + series_of([3], face=6) + series_of([None, None], face=7)
    rows += series_of([math.sin(k) for k in range(30)], step_min=60 * 24 * 3, face=8)  # gaps longer than the overlap
    rows += [(9, T0, 1.0), (9, T0, 2.0), (9, T0, 0.5), (9, T0 + dt.timedelta(hours=1), 0.0), (None, T0, 1.0), (1, None, 5.0)]
    return rows


@pytest.mark.parametrize(("range_days", "overlap_days"), [(1.0, 0.5), (3.0, 1.0), (6.0, 0.0), (64.0, 8.0)])
def test_points_in_ranges_are_those_of_whole_series(spark, range_days, overlap_days):
    rows = mixed_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    points = tides.tidal_points(df, ["face_id"], "zeta", range_days=range_days, overlap_days=overlap_days).where("kind <> 'stats'")
    got = {(r.face_id, r.kind, r.t.replace(tzinfo=None), r.level) for r in points.withColumn("t", tides.as_time("t_").cast("timestamp_ntz")).collect()}
    assert got == {e for e in expected_points([r for r in rows if r[1] is not None]) if e[0] is not None} and len(got) > 100


def test_a_hot_face_is_split_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(series_of(np.sin(np.arange(24 * 300) / 2)), SCHEMA)
        slim = df.selectExpr("face_id", "unix_micros(cast(time as timestamp)) AS t_", "zeta AS x_")
        rows = tides.in_ranges(slim, ["face_id"], 0.05, 20.0, 2.0).selectExpr("kind", "spark_partition_id() AS p").where("kind = 'stats'").collect()
        assert len(rows) == 15 + 1 and len({r.p for r in rows}) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_cycles(spark):
    #          high 2      low -1      high 1.5   lows 0.2, -0.4   high 3 ; then a rise without end
    x = [0, 2, 1, -1, 0.5, 1.5, 0.2, 0.22, -0.4, 1, 3, 0, 0.5]
    rows = series_of(x, step_min=180) + series_of([0, 1, 0], face=2) + series_of([1.0] * 9, face=3)
    cycles = tides.tidal_cycles(spark.createDataFrame(rows, SCHEMA), ["face_id"], "zeta")
    hour = lambda k: T0 + dt.timedelta(hours=3 * k)
    got = [(r.face_id, r.cycle, r.high_time.replace(tzinfo=None), r.high_level, r.low_time.replace(tzinfo=None), r.low_level, r.tidal_range, r.period_s) for r in cycles.orderBy("cycle").collect()]
    assert got == [(1, 1, hour(1), 2.0, hour(3), -1.0, 3.0, 12 * 3600.0), (1, 2, hour(5), 1.5, hour(8), -0.4, 1.9, 15 * 3600.0)]
    stats = tides.cycle_ranges(cycles, ["face_id"]).collect()
    assert [(r.face_id, r.n_cycles, r.average_range, r.min_range, r.max_range, r.min_range_time.replace(tzinfo=None)) for r in stats] == [(1, 2, pytest.approx(2.45), 1.9, 3.0, hour(5))]
    assert tides.tidal_cycles(spark.createDataFrame([], SCHEMA), ["face_id"], "zeta").count() == 0


def test_summary_of_mixed_series(spark):
    rows = mixed_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r.face_id: r for r in tides.tidal_summary(df, ["face_id"], "zeta", range_days=3.0, overlap_days=1.0).collect()}
    assert set(out) == {None, *range(1, 10)}
    own = sorted((t, z) for f, t, z in rows if f == 1 and t is not None)
    x = np.array([z for _, z in own])
    high, low = x[plain_peaks(x.tolist())], x[plain_peaks((-x).tolist())]
    assert (out[1].high_mean, out[1].low_mean, out[1].high_max, out[1].low_min) == pytest.approx((high.mean() - x.mean(), low.mean() - x.mean(), high.max() - x.mean(), low.min() - x.mean()))
    assert (out[2].tidal_range, out[2].tide_type, out[2].average_period_s) == (0, "Unknown", 0) and out[7].mean_level is None
    assert (out[6].mean_level, out[6].high_max, out[6].low_min) == (3, 0, 0)
