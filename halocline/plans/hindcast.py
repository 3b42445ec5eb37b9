"""The pipeline from raw facts to summaries, as one graph per step.

raw facts -> standardized (verified, first of duplicates, clipped) -> derived -> yearly or monthly summaries ->
wide tables of all locations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halocline.functions import flow, names
from halocline.operators import derive, reshape, summary, tides, timeline

KEYS = ["location", "face_id"]


@dataclass(frozen=True)
class Location:
    """A region's time span and step."""

    name: str
    output_name: str
    start: str
    end: str
    step_s: int
    utm_zone: int | None = None
    bucket: str = "month"


# The five regions.
LOCATIONS = {
    x.name: x
    for x in (
        Location("aleutian_islands", "AK_aleutian_islands", "2010-06-03 00:00:00", "2011-06-02 23:00:00", 3600, bucket="5 days"),
        Location("cook_inlet", "AK_cook_inlet", "2005-01-01 00:00:00", "2005-12-31 23:00:00", 3600),
        Location("piscataqua_river", "NH_piscataqua_river", "2007-01-01 00:00:00", "2007-12-31 23:30:00", 1800, 19),
        Location("puget_sound", "WA_puget_sound", "2015-01-01 00:00:00", "2015-12-30 23:30:00", 1800, 10, "5 days"),
        Location("western_passage", "ME_western_passage", "2017-01-01 00:00:00", "2017-12-31 23:30:00", 1800, 19),
    )
}


def expected_steps(loc: Location) -> int:
    from datetime import datetime

    span = datetime.fromisoformat(loc.end) - datetime.fromisoformat(loc.start)
    return int(span.total_seconds()) // loc.step_s + 1


def standardize(fact: DataFrame, loc: Location, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key and stamp within the location's span."""
    return timeline.keep_first(timeline.clip(fact, loc.start, loc.end), [*keys, "time"], order)


def verify(fact: DataFrame, loc: Location, keys: list[str]) -> DataFrame:
    """A row per series with what is wrong with its times; none when all is well."""
    report = timeline.time_report(fact, keys)
    problem = (
        F.when(F.col("n_rows") != expected_steps(loc), "steps")
        .when(F.col("n_duplicates") > 0, "duplicates")
        .when(F.abs(F.col("min_delta_s") - loc.step_s) > 0.001, "short step")
        .when(F.abs(F.col("max_delta_s") - loc.step_s) > 0.001, "gap")
    )
    return report.withColumn("problem", problem).where("problem is not null")


def derive_layers(velocity: DataFrame) -> DataFrame:
    return derive.add_flow(velocity)


def derive_columns(layers: DataFrame) -> DataFrame:
    """Water column values per face and time: depth means, and maxima of speed and power."""
    means = [F.avg(c).alias(f"water_column_mean_{c}") for c in derive.DEPTH_VARIABLES]
    return layers.groupBy(*KEYS, "time").agg(*means, F.max("speed").alias("water_column_max_speed"), F.max("power_density").alias("water_column_max_power_density"))


def derive_surface(zeta: DataFrame, face_node: DataFrame, face: DataFrame) -> DataFrame:
    centre = derive.gather_nodes(face_node, zeta, "zeta", KEYS, ["time"])
    return derive.add_depths(centre, face, KEYS)


def summarize(layers: DataFrame, columns: DataFrame, surface: DataFrame, loc: Location, period: str | None = None) -> DataFrame:
    """One wide row per face, or per face and month with ``period="month"``."""
    keys = list(KEYS)
    if period == "month":
        layers, columns, surface = (d.withColumn("month", timeline.month_bucket()) for d in (layers, columns, surface))
        keys.append("month")
    hours = loc.step_s / 3600
    column = summary.statistics(columns, keys, [c for c in columns.columns if c.startswith("water_column_mean")], ["water_column_max_speed", "water_column_max_power_density"])
    per_layer = layers.groupBy(*keys, "sigma_layer").agg(*[F.avg(c).alias(c) for c in ("u", "v", "speed", "to_direction", "power_density")])
    wide = reshape.pivot_layers(per_layer, keys, ["u", "v", "speed", "to_direction", "power_density"])
    tide = tides.tidal_summary(surface, keys)
    top = summary.surface_layer(layers, keys, "speed")
    # the slope of the water is one value per face and time, taken before its layers multiply the rows
    slopes = surface.select(*keys, "time", summary.gradient("surface_elevation", keys, ["time"]).alias("slope"))
    phases = summary.flood_ebb(layers.join(slopes, [*keys, "time"]), [*keys, "sigma_layer"], ["time"], "to_direction", "speed", None, hours_per_step=hours, slope="slope")
    phase = phases.groupBy(*keys).agg(*[F.avg(f"{p}_{c}").alias(f"{p}_{c}_depth_avg") for p in ("flood", "ebb") for c in ("direction", "mean_speed")])
    height = summary.column_height(surface, keys)
    out = column
    for part in (wide, top, height, tide, phase):  # all are grouped by the same keys, so the joins reuse that partitioning
        out = out.join(part, keys, "left")
    return out.withColumn("max_to_mean_ratio_speed", flow.max_to_mean_ratio("water_column_max_speed_p95", "water_column_mean_speed_mean"))


def atlas(summaries: dict[str, DataFrame], face: DataFrame) -> DataFrame:
    """All locations under each other with positions, labels and links."""
    every = reshape.union_all({LOCATIONS[k].output_name: df.drop("location") for k, df in summaries.items()})
    at = face.select("location", "face_id", "lat_center", "lon_center")
    joined = every.join(at, KEYS, "left")
    return joined.withColumn("face_label", names.face_label("face_id")).withColumn("full_year_data_uri", names.full_year_uri("s3://bucket/", "location", "face_id", "lat_center", "lon_center"))
