"""Coast lines and boundaries: the nearest point of a coast, and points in large rings, also over the date line.

Both work on a grid of cells.  A coast's segments are listed in the cells that they cross, and a ring is cut to the cells
that it covers, so that no cell gets more of a line or ring than lies in it, and all joins are on equal cells.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halocline.functions import geo

#: Of the equidistant cylindrical projection (EPSG:4087), along both axes.
METRES_PER_DEGREE = math.pi * geo.WGS84_A / 180

#: Search radii in kilometres: those of most regions, and those of the one on the date line, whose shores lie farther off.
RADII_KM = (4.0, 64.0, 1000.0)
DATE_LINE_RADII_KM = (4.0, 64.0, 1000.0, 5000.0)

#: Search cells for radii from here on are cut into CUTS rows and columns; the segments are listed in the small cells.
CUT_FROM_KM = 16.0
CUTS = 8

UNITS = {"nautical_miles": (1852.0, 1.0), "km": (1000.0, 2.0)}  # metres of a unit; nearer than so many units is on land

# ---------------------------------------------------------------- distance to a coast


def segments(lines: DataFrame, line: str = "line", label: str | None = None) -> DataFrame:
    """(x1, y1, x2, y2, label) in degrees of coast lines, arrays of (lon, lat); a line of one point is a segment without length.

    A segment takes the shorter way around the globe, so x2 may lie beyond 180 degrees.  ``label`` names a column of the
    line as text; without it labels are empty.
    """
    last = F.greatest(F.size(line) - 1, F.lit(1))
    ends = lines.where(F.size(line) > 0).select((F.col(label).cast("string") if label else F.lit("")).alias("label"), F.explode(F.arrays_zip(F.slice(line, 1, last).alias("a"), F.slice(line, 2, last).alias("b"))).alias("s"))
    out = ends.select(F.col("s.a.lon").alias("x1"), F.col("s.a.lat").alias("y1"), F.coalesce("s.b.lon", "s.a.lon").alias("x2"), F.coalesce("s.b.lat", "s.a.lat").alias("y2"), "label")
    out = out.withColumn("x2", F.col("x1") + geo.normalize_longitude(F.col("x2") - F.col("x1"))).dropna(subset=["x1", "y1", "x2", "y2"])
    return out.distinct()  # lines that run together count once


def crossed_cells(segs: DataFrame, size: float, columns: int) -> DataFrame:
    """Segments with every cell (fy, fx) that they cross or touch; ``columns`` cells of ``size`` degrees go around the globe."""
    edge = 1e-9  # degrees; what lies on an edge is listed on both sides
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    cell = lambda v: F.floor(v / size).cast("int")
    rows = segs.withColumn("fy", F.explode(F.sequence(cell(low - edge), cell(high + edge))))
    # the part of the segment that lies in the row
    at = lambda y: F.col("x1") + F.try_divide(y - F.col("y1"), F.col("y2") - F.col("y1")) * (F.col("x2") - F.col("x1"))
    bottom, top = F.least(F.greatest(low, F.col("fy") * size), high), F.greatest(F.least(high, (F.col("fy") + 1) * size), low)
    flat = F.col("y1") == F.col("y2")
    a, b = F.when(flat, F.col("x1")).otherwise(at(bottom)), F.when(flat, F.col("x2")).otherwise(at(top))
    across = F.sequence(cell(F.least(a, b) + 180 - edge), cell(F.greatest(a, b) + 180 + edge))
    return rows.withColumn("fx", F.explode(across)).withColumn("fx", F.pmod("fx", F.lit(columns)))


def nearest_on_segment(lat: str, lon: str) -> Column:
    """(degrees, lat, lon, label) of the point of a segment (x1, y1)-(x2, y2) that is nearest to (lat, lon) on the plane."""
    half = (F.col("x2") - F.col("x1")) / 2
    ax = geo.normalize_longitude(F.col("x1") + half - F.col(lon)) - half  # the copy of the segment nearest to the point
    ay, dx, dy = F.col("y1") - F.col(lat), F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    share = F.coalesce(F.least(F.greatest(F.try_divide(-(ax * dx + ay * dy), dx * dx + dy * dy), F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    x, y = ax + share * dx, ay + share * dy
    return F.struct(F.sqrt(x * x + y * y).alias("degrees"), (F.col(lat) + y).alias("lat"), geo.normalize_longitude(F.col(lon) + x).alias("lon"), F.col("label"))


def nearest_within(at: DataFrame, segs: DataFrame, radius_km: float) -> DataFrame:
    """(lat, lon, hit) of the positions that have a segment within the radius, with its nearest point.

    Search cells are as large as the radius, so all that counts lies in a position's cell and the eight around it.  Small
    search cells hold few segments, and all are measured.  In large ones a position meets the small cells that any segment
    crosses first: the farthest corner of one bounds its distance from above, the nearest edge from below.  Only segments
    in cells that are not out of the question are measured.
    """
    radius = radius_km * 1000 / METRES_PER_DEGREE
    columns = max(1, int(360 // radius))
    size = 360.0 / columns
    cuts = CUTS if radius_km >= CUT_FROM_KM else 1
    small, many = size / cuts, columns * cuts
    index = crossed_cells(segs, small, many)
    row, column = F.floor(F.col("lat") / size).cast("int"), F.floor((F.col("lon") + 180) / size).cast("int")
    asked = at.withColumn("by", F.explode(F.sequence(row - 1, row + 1)))
    asked = asked.withColumn("bx", F.explode(F.array_distinct(F.transform(F.sequence(column - 1, column + 1), lambda c: F.pmod(c, F.lit(columns))))))
    if cuts == 1:
        return nearest_hits(asked.withColumnsRenamed({"by": "fy", "bx": "fx"}), index, radius)
    block = lambda c: F.floor(F.col(c) / cuts).cast("int")
    occupied = index.select("fy", "fx").distinct().withColumn("by", block("fy")).withColumn("bx", block("fx"))
    met = asked.join(occupied.hint("merge"), ["by", "bx"]).drop("by", "bx")
    dy = F.abs((F.col("fy") + 0.5) * small - F.col("lat"))
    dx = F.abs(geo.normalize_longitude((F.col("fx") + 0.5) * small - 180 - F.col("lon")))
    far = F.hypot(dx + small / 2, dy + small / 2)
    near = F.hypot(F.greatest(dx - small / 2, F.lit(0.0)), F.greatest(dy - small / 2, F.lit(0.0)))
    met = met.select("lat", "lon", "fy", "fx", near.alias("near"), far.alias("far"))
    bound = F.min("far").over(Window.partitionBy("lat", "lon"))  # of 9 * cuts ** 2 cells at most
    slack = 1e-6  # degrees, more than what cells are listed too many
    open_cells = met.withColumn("bound", bound).where((F.col("near") <= F.col("bound") + slack) & (F.col("near") <= radius)).select("lat", "lon", "fy", "fx")
    return nearest_hits(open_cells, index, radius)


def nearest_hits(cells: DataFrame, index: DataFrame, radius: float) -> DataFrame:
    """The nearest point of the segments in each position's cells (fy, fx), within a radius in degrees.

    The index grows out of few lines, whose size says nothing of its own, so it is never broadcast.
    """
    hits = cells.join(index.hint("merge"), ["fy", "fx"]).select("lat", "lon", nearest_on_segment("lat", "lon").alias("hit"))
    return hits.where(F.col("hit.degrees") <= radius).groupBy("lat", "lon").agg(F.min("hit").alias("hit"))


def distance_to_coast(points: DataFrame, lines: DataFrame, line: str = "line", radii_km: tuple[float, ...] = RADII_KM, units: str = "nautical_miles", strict: bool = False, label: str | None = None) -> DataFrame:
    """``points`` (lat, lon) with the distance to the nearest point of any coast line, in projected metres, and that point.

    Distances are planar in the equidistant cylindrical projection, over the date line too.  Nearer than one nautical mile
    (two kilometres) counts as on land: distance 0, and the point itself.  Radii are tried in turn, each on the positions
    that are still open only; open positions are written between rounds, and no round is run when none is open.
    Beyond the last radius all three are null, or, if ``strict``, an error names the first such positions.  Segments
    span less than 180 degrees.  Equal positions are searched once; a null position has nulls; of equally near points the
    southernmost counts, then the westernmost.  With ``label``, a column of the lines, that of the nearest one comes along
    as ``closest_label``.
    """
    metres, land = UNITS[units]
    segs = segments(lines, line, label)
    found: DataFrame | None = None
    open_ = points.select(F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")).dropna().distinct().checkpoint()
    for radius in radii_km:
        state = open_.join(nearest_within(open_, segs, radius).hint("merge"), ["lat", "lon"], "left").checkpoint()
        hits, open_ = state.where("hit IS NOT NULL"), state.where("hit IS NULL").drop("hit")
        found = hits if found is None else found.unionByName(hits)
        if open_.isEmpty():
            break
    if strict and not open_.isEmpty():
        raise ValueError(f"no coast within {radii_km[-1]} km of {open_.count()} positions, the first (lat, lon): {[tuple(r) for r in open_.orderBy('lat', 'lon').limit(5).collect()]}")
    away = F.col("hit.degrees") * METRES_PER_DEGREE / metres
    on_land = away < land
    shores = found.select(
        F.col("lat").alias("lat_"),
        F.col("lon").alias("lon_"),
        F.when(on_land, 0.0).otherwise(away).alias("distance_to_shore"),
        F.when(on_land, F.col("lat")).otherwise(F.col("hit.lat")).alias("closest_shore_lat"),
        F.when(on_land, F.col("lon")).otherwise(F.col("hit.lon")).alias("closest_shore_lon"),
        *([F.col("hit.label").alias("closest_label")] if label else []),
    )
    return points.join(shores, (F.col("lat").cast("double") == F.col("lat_")) & (F.col("lon").cast("double") == F.col("lon_")), "left").drop("lat_", "lon_")


# ---------------------------------------------------------------- rings cut to cells


def unwrapped(ring: np.ndarray) -> np.ndarray:
    """A ring (lon, lat) without its closing point, whose longitudes go on over the date line.

    A step of 180 to 360 degrees goes the other way around; one of 360 degrees is a walk around the globe.  A ring around
    a pole is closed over the pole.
    """
    if len(ring) > 1 and (ring[0] == ring[-1]).all():
        ring = ring[:-1]
    step = np.diff(ring[:, 0], append=ring[:1, 0])
    turn = np.where((np.abs(step) > 180) & (np.abs(step) < 360 - 1e-9), -360 * np.sign(step), 0)
    lon = ring[:, 0] + np.concatenate(([0], np.cumsum(turn)[:-1]))
    out = np.column_stack((lon, ring[:, 1]))
    around = turn.sum()
    if around:
        pole = math.copysign(90.0, ring[:, 1].mean())
        first = [lon[0] + around, ring[0, 1]]  # the first point again, a turn further on
        out = np.vstack((out, [first, [first[0], pole], [lon[0], pole]]))
    return out


def clip(ring: np.ndarray, axis: int, edge: float, above: bool) -> np.ndarray:
    """The part of a ring on one side of a line parallel to an axis; where it falls apart, its parts hang together by edges
    on the line, which do not change what an even-odd test finds."""
    v = ring[:, axis]
    inside = v >= edge if above else v <= edge
    if inside.all() or not inside.any():
        return ring if len(ring) and inside.all() else ring[:0]
    before, were = np.roll(ring, 1, axis=0), np.roll(inside, 1)
    crossing = inside != were
    share = np.zeros(len(ring))
    share[crossing] = (edge - before[crossing, axis]) / (v[crossing] - before[crossing, axis])
    cut = before + (ring - before) * share[:, None]
    cut[:, axis] = edge
    both = np.stack((cut, ring), axis=1).reshape(-1, 2)
    return both[np.stack((crossing, inside), axis=1).reshape(-1)]


def split(ring: np.ndarray, axis: int, size: float, low: int, high: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number, part) of each strip low..high of ``size`` that the ring reaches into, halving the strips."""
    if len(ring) < 3:
        return
    if low == high:
        yield low, ring
        return
    middle = (low + high + 1) // 2
    yield from split(clip(ring, axis, middle * size, False), axis, size, low, middle - 1)
    yield from split(clip(ring, axis, middle * size, True), axis, size, middle, high)


def cell_parts(ring: np.ndarray, size: float) -> Iterator[tuple[int, int, np.ndarray]]:
    """(cell_y, cell_x, part) of a ring, cells counted from longitude -180 around the globe; parts in -180..180."""
    if len(ring) < 3:
        return
    ring = unwrapped(ring)
    columns = round(360 / size)
    reach = lambda part, axis, base: (math.floor((part[:, axis].min() + base) / size), math.floor((part[:, axis].max() + base) / size))
    moved = ring + [180.0, 0.0]
    for y, strip in split(moved, 1, size, *reach(moved, 1, 0)):
        for x, part in split(strip, 0, size, *reach(strip, 0, 0)):
            if np.ptp(part[:, 0]) > 0 and np.ptp(part[:, 1]) > 0:
                yield y, x % columns, part - [180.0 + 360.0 * (x // columns), 0.0]


def clipped_rings(polygons: DataFrame, ring: str = "ring", size: float = 1.0) -> DataFrame:
    """Polygons with a row per cell (cell_y, cell_x) that they cover and, in ``ring``, the part that lies there.

    A ring is an array of (lon, lat), closed or not; ``size`` divides 360.  Cells inside a ring get a square.
    """
    if abs(360 / size - round(360 / size)) > 1e-9:
        raise ValueError("the size of a cell must divide 360 degrees")
    spark = polygons.sparkSession
    kept = [c for c in polygons.columns if c != ring]
    fields = {f.name: f.dataType.simpleString() for f in polygons.schema}
    schema = ", ".join([f"`{c}` {fields[c]}" for c in kept] + ["cell_y int", "cell_x int", f"`{ring}` array<struct<lon: double, lat: double>>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cells, parts = [], [], []
            for k, corners in enumerate(batch.column(len(kept)).to_pylist()):
                for y, x, part in cell_parts(np.array([(p["lon"], p["lat"]) for p in corners or ()], float).reshape(-1, 2), size):
                    rows.append(k)
                    cells.append((y, x))
                    parts.append(part)
            flat = np.concatenate(parts) if parts else np.zeros((0, 2))
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
            points = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in (0, 1)], ["lon", "lat"])
            own = batch.take(pa.array(rows, pa.int64())).columns[: len(kept)]
            cy, cx = (pa.array([c[k] for c in cells], pa.int32()) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([*own, cy, cx, pa.ListArray.from_arrays(pa.array(offsets), points)], [*kept, "cell_y", "cell_x", ring])

    # few rows with much work each: spread by content over all tasks, which are not put together again for their size
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return polygons.select(*kept, ring).repartition(n, F.xxhash64(*kept, ring)).mapInArrow(run, schema)


#: Most rows that one row of gathered() stands for.
MOST_MEMBERS = 1_000


def gathered(df: DataFrame, keys: list[str], into: str, most: int = MOST_MEMBERS) -> DataFrame:
    """(keys, ``into``): the other columns of rows with equal keys as an array of structs, about ``most`` in each.

    Keys with more rows are dealt over several arrays by a hash of the row.
    """
    crowded = df.groupBy(*[F.col(k).alias(f"{k}_") for k in keys]).agg(F.ceil(F.count("*") / most).alias("parts_")).where("parts_ > 1")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys])
    dealt = df.withColumn("hash_", F.xxhash64(*df.columns)).join(crowded, same, "left").withColumn("part_", F.pmod("hash_", F.coalesce("parts_", F.lit(1))))
    others = F.struct(*[c for c in df.columns if c not in keys])
    return dealt.groupBy(*keys, "part_").agg(F.collect_list(others).alias(into)).drop("part_")


def bounded(parts: DataFrame, ring: str) -> DataFrame:
    """Rings with their bounds, ``low_`` and ``high_``, and whether they are a box, as those of cells inside a polygon."""
    ends = lambda f: F.struct(*[f(F.transform(ring, lambda p: p[c])).alias(c) for c in ("lon", "lat")])  # noqa: B023, E731
    out = parts.withColumn("low_", ends(F.array_min)).withColumn("high_", ends(F.array_max))
    corners = F.forall(ring, lambda p: p["lon"].isin(F.col("low_.lon"), F.col("high_.lon")) & p["lat"].isin(F.col("low_.lat"), F.col("high_.lat")))
    full = (F.col("high_.lon") - F.col("low_.lon")) * (F.col("high_.lat") - F.col("low_.lat"))
    return out.withColumn("box_", (F.size(ring) == 4) & corners & (ring_area(ring) > 0.75 * full))


def points_in_rings(points: DataFrame, polygons: DataFrame, ring: str = "ring", size: float = 1.0) -> DataFrame:
    """(point, polygon) pairs where the point lies inside, by the part of the ring in the point's own cell.

    Equal positions and equal rings are tested once; their rows stand in arrays, of which the pairs are made in the task
    that has tested them.
    """
    columns = round(360 / size)
    lon = geo.normalize_longitude("lon")
    own, kept = [c for c in points.columns if c not in ("lat", "lon")], [c for c in polygons.columns if c != ring]
    places = gathered(points.dropna(subset=["lat", "lon"]), ["lat", "lon"], "points_") if own else points
    at = places.withColumn("cell_y", F.floor(F.col("lat") / size).cast("int")).withColumn("cell_x", F.pmod(F.floor((lon + 180) / size).cast("int"), F.lit(columns)))
    shapes = gathered(polygons, [ring], "polygons_") if kept else polygons
    # the parts grow out of few rings, whose size says nothing of their own, so they are never broadcast
    parts = bounded(clipped_rings(shapes, ring, size), ring)
    met = at.withColumn("at_", lon).join(parts.hint("merge"), ["cell_y", "cell_x"])
    met = met.where(F.col("lat").between(F.col("low_.lat"), F.col("high_.lat")) & F.col("at_").between(F.col("low_.lon"), F.col("high_.lon")))
    inside = F.when(F.col("box_"), (F.col("lat") < F.col("high_.lat")) & (F.col("at_") < F.col("high_.lon"))).otherwise(geo.point_in_ring("lat", F.col("at_"), ring))
    met = met.where(inside).drop("cell_y", "cell_x", ring, "at_", "low_", "high_", "box_")
    if own:
        met = met.withColumn("points_", F.explode("points_"))
    if kept:
        met = met.withColumn("polygons_", F.explode("polygons_"))
    return met.select(*[F.col(c) if c in ("lat", "lon") else F.col(f"points_.{c}") for c in points.columns], *[F.col(f"polygons_.{c}") for c in kept])


# ---------------------------------------------------------------- jurisdiction

#: What a label was taken from, as given in ``jurisdiction_source``.
SOURCES = {"state": "coastal states", "territorial sea": "territorial sea limits", "eez": "exclusive economic zone limits", "czma": "coastal zone management areas", "none": "None"}
EEZ, OUTSIDE, RULE, NOT_FOUND = "exclusive economic zone", "outside", "federal consistency", "not found"


def jurisdiction(found: DataFrame, keys: list[str], date_line: bool = False, two_states: str = "error", sources: dict[str, str] = SOURCES) -> DataFrame:
    """(keys, jurisdiction, jurisdiction_source): a label per point from all boundaries that contain it, and its source.

    A point in no boundary has one row of nulls.  In this order: state waters; the territorial sea, unless its region is an
    Atlantic or Pacific coast, where claims away from a state's waters are left out; the exclusive economic zone; management
    areas of federal consistency (of several areas one must be named just so, other areas give "not found"); Alaska;
    outside.  For the region on the date line (``date_line``) only the first three and outside, without exceptions.
    Two states at once are an error, or with ``two_states="join"`` a label of both.
    """
    return labels(flags_of(found, keys), keys, date_line, two_states, sources)


def flags_of(found: DataFrame, keys: list[str]) -> DataFrame:
    """What counts of the boundaries that contain a point; with ``copies_`` a row of ``found`` stands for so many boundaries."""
    text = lambda c: F.col(c) if c in found.columns else F.lit(None).cast("string")
    flag = lambda c: F.coalesce(F.max(c), F.lit(False))
    region = lambda *names: reduce(Column.__or__, [text("REGION").contains(n) for n in names])
    area = F.when(F.col("source") == "czma", text("CZMADomain"))
    copies = F.col("copies_") if "copies_" in found.columns else F.lit(1).cast("long")
    # states first: what is left of a point are a few rows of plain columns, which tasks can sum up before any shuffle
    by_state = found.groupBy(*keys, F.when(F.col("source") == "state", F.col("stateName")).alias("state")).agg(
        F.max(F.col("TS") > 0).alias("in_ts"),
        F.max(F.col("EEZ") > 0).alias("in_eez"),
        F.max(region("Atlantic Coast", "Pacific Coast")).alias("coast"),
        F.max(text("REGION") == "Alaska").alias("alaska"),
        F.sum(F.when(area.isNotNull(), copies)).alias("areas"),
        F.max(area == RULE).alias("ruled"),
        F.max(area.contains(RULE)).alias("like_rule"),
    )
    return by_state.groupBy(*keys).agg(F.array_sort(F.collect_set("state")).alias("states"), *[flag(c).alias(c) for c in FLAGS], F.coalesce(F.sum("areas"), F.lit(0)).alias("areas"))


FLAGS = ("in_ts", "in_eez", "coast", "alaska", "ruled", "like_rule")


def labels(flags: DataFrame, keys: list[str], date_line: bool, two_states: str, sources: dict[str, str]) -> DataFrame:
    states = F.array_join("states", "/")
    if two_states == "error":
        states = F.when(F.size("states") > 1, F.raise_error(F.concat(F.lit("a point lies in more than one state: "), states)).cast("string")).otherwise(states)
    label = lambda what, source: F.struct((F.lit(what) if isinstance(what, str) else what).alias("jurisdiction"), F.lit(sources.get(source, source)).alias("jurisdiction_source"))
    outside, eez = label(OUTSIDE, "none"), label(EEZ, "eez")
    consistent = F.col("ruled") | ((F.col("areas") == 1) & F.col("like_rule"))
    at_sea = label("territorial sea", "territorial sea")
    picked = F.when(F.size("states") > 0, label(F.concat(states, F.lit(" state waters")), "state"))
    if date_line:
        picked = picked.when(F.col("in_ts"), at_sea).when(F.col("in_eez"), eez).otherwise(outside)
    else:
        picked = picked.when(F.col("in_ts"), F.when(F.col("coast"), outside).otherwise(at_sea)).when(F.col("in_eez"), eez)
        picked = picked.when(F.col("areas") > 0, F.when(consistent, label(EEZ, "czma")).otherwise(label(NOT_FOUND, NOT_FOUND)))
        picked = picked.when(F.col("alaska"), eez).otherwise(outside)
    return flags.select(*keys, picked.alias("p")).select(*keys, "p.jurisdiction", "p.jurisdiction_source")


def label_points(points: DataFrame, boundaries: DataFrame, keys: list[str], ring: str = "ring", size: float = 1.0, **settings: object) -> DataFrame:
    """Each point's label and source from boundary rings with the columns that ``jurisdiction`` asks for.

    Rings may lie across the date line: they are unwrapped and cut to cells, so points on both sides of it are labelled.
    """
    asked = points.select(*keys, "lat", "lon").distinct()
    alike = boundaries.groupBy(*boundaries.columns).agg(F.count("*").alias("copies_"))
    met = points_in_rings(asked.select("lat", "lon").dropna().distinct(), alike, ring, size)
    found = flags_of(met, ["lat", "lon"])
    at = asked.join(found.withColumnsRenamed({"lat": "lat_", "lon": "lon_"}).hint("merge"), (F.col("lat") == F.col("lat_")) & (F.col("lon") == F.col("lon_")), "left")
    # a key with several positions lies in all that they lie in
    flags = at.groupBy(*keys).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("states")))).alias("states"), *[F.coalesce(F.max(c), F.lit(False)).alias(c) for c in FLAGS], F.coalesce(F.sum("areas"), F.lit(0)).alias("areas"))
    return labels(flags, keys, **{"date_line": False, "two_states": "error", "sources": SOURCES} | settings)


# ---------------------------------------------------------------- time zones

#: Radii within which a position at sea takes the nearest zone.
ZONE_RADII_KM = (64.0, 1000.0, 5000.0)


def time_zones(points: DataFrame, zones: DataFrame, zone: str = "zone", ring: str = "ring", size: float = 1.0, day: str = geo.OFFSET_DAY) -> DataFrame:
    """``points`` (lat, lon) with ``time_zone`` and ``utc_offset_hours`` at noon of a day, in whole hours towards zero.

    Of the zones' rings that hold a position the smallest counts (planar area; of equal ones the first by name), so that an
    enclave goes before what lies around it.  A position in none, at sea, takes the zone of the nearest ring; one beyond the
    last radius is at Greenwich, as are the offsets of a null position.
    """
    at = points.select("lat", "lon").dropna().distinct()
    sized = zones.select(F.col(zone).alias("zone_"), ring, F.round(ring_area(ring), 6).alias("area_"))
    inside = points_in_rings(at, sized, ring, size).groupBy("lat", "lon").agg(F.min(F.struct("area_", "zone_")).alias("z")).select("lat", "lon", F.col("z.zone_").alias("time_zone")).checkpoint()
    closed = zones.select(F.col(zone).alias("zone_"), F.when(F.size(ring) > 0, F.concat(ring, F.slice(ring, 1, 1))).alias("line_"))
    open_ = at.join(inside, ["lat", "lon"], "left_anti")
    near = distance_to_coast(open_, closed, "line_", ZONE_RADII_KM, label="zone_").select("lat", "lon", F.col("closest_label").alias("time_zone"))
    known = inside.unionByName(near).withColumnsRenamed({"lat": "lat_", "lon": "lon_"})
    out = points.join(known, (F.col("lat") == F.col("lat_")) & (F.col("lon") == F.col("lon_")), "left").drop("lat_", "lon_")
    return out.withColumn("time_zone", F.coalesce("time_zone", F.lit("Etc/GMT"))).withColumn("utc_offset_hours", geo.utc_offset_hours("time_zone", day))


def ring_area(ring: str) -> Column:
    """Planar area of a ring in square degrees; steps over the date line go the short way."""
    n = F.size(ring)
    first = F.get(ring, F.lit(0))["lon"]

    def term(i: Column) -> Column:
        p, q = F.get(ring, i), F.get(ring, F.pmod(i + 1, n))
        x0, x1 = geo.normalize_longitude(p["lon"] - first), geo.normalize_longitude(q["lon"] - first)
        return x0 * q["lat"] - x1 * p["lat"]

    return F.abs(F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), term), F.lit(0.0), lambda a, b: a + b)) / 2
