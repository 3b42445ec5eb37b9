"""Published manifests: which cells have points, and where the file of a point lies.

A manifest is a folder with four tables: ``spec`` (one row), ``locations`` (version, step and start of each), and
``grid_index`` and ``grid_points`` as write_manifest lays them down.  Points keep the text of their position, so that a
path has exactly the digits that the file was written with.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from halocline.functions import names
from halocline.functions.flow import ColumnOrName, as_col
from halocline.sources.writers import write_manifest

SPEC = "spec_version string, manifest_version string, data_level string, decimal_places int, index_digits int, template string, public_base string, local_base string"
LOCATIONS = "location string, latest_version string, temporal string, date string, time string"


@dataclass(frozen=True)
class Manifest:
    spec: dict
    locations: DataFrame
    index: DataFrame
    points: DataFrame

    def cell(self, grid_id: str) -> DataFrame:
        """(location, face_id, lat, lon) of one cell's points; only that cell's rows are read on."""
        return self.points.where(F.col("grid_id") == grid_id).select("location", F.explode("points").alias("p")).select("location", "p.face_id", "p.lat", "p.lon")

    def paths(self, points: DataFrame, version: str | None = None) -> DataFrame:
        """``points`` (location, face_id, lat, lon as text) with the path of each one's file; null for an unknown location."""
        return point_paths(points, self.locations, self.spec["template"], self.spec["data_level"], self.spec["decimal_places"], self.spec["index_digits"], version)

    def full_path(self, relative: ColumnOrName, local: ColumnOrName) -> Column:
        return full_path(relative, local, self.spec["public_base"], self.spec["local_base"])


def write(spec: DataFrame, locations: DataFrame, index: DataFrame, points: DataFrame, path: str) -> None:
    spec.coalesce(1).write.mode("overwrite").json(f"{path}/spec")  # one row
    locations.write.mode("overwrite").json(f"{path}/locations")
    write_manifest(index, points, path)


def load(spark: SparkSession, path: str, major: int = 2) -> Manifest:
    """A manifest of at least that major version of the specification."""
    spec = spark.read.schema(SPEC).json(f"{path}/spec").first()
    version = (spec["spec_version"] if spec else None) or ""
    if not version.split(".")[0].isdigit() or int(version.split(".")[0]) < major:
        raise ValueError(f"manifest of specification {version or 'unknown'}; {major}.0.0 or later is read")
    locations = spark.read.schema(LOCATIONS).json(f"{path}/locations")
    return Manifest(spec.asDict(), locations, spark.read.json(f"{path}/grid_index"), spark.read.json(f"{path}/grid_points"))


def point_paths(points: DataFrame, locations: DataFrame, template: str, data_level: str, decimals: int = 2, digits: int = 8, version: str | None = None) -> DataFrame:
    """``points`` with the column ``path``: the template filled from the point's texts and its location's row.

    Locations are few (a row per region); they join without a hint.
    """
    known = locations.select("location", F.lit(version).alias("version_") if version else F.col("latest_version").alias("version_"), "temporal", "date", "time")
    joined = points.join(known, "location", "left")
    lat, lon = F.col("lat").cast("double"), F.col("lon").cast("double")
    values = {
        "location": "location",
        "data_version": "version_",
        "data_level": F.lit(data_level),
        "lat_deg": names.degree_key(lat).cast("string"),
        "lon_deg": names.degree_key(lon).cast("string"),
        "lat_dec": names.decimal_key(lat, decimals),
        "lon_dec": names.decimal_key(lon, decimals),
        "face_id": F.when(F.length(F.col("face_id").cast("string")) >= digits, F.col("face_id").cast("string")).otherwise(F.lpad(F.col("face_id").cast("string"), digits, "0")),
        "lat": F.col("lat").cast("string"),
        "lon": F.col("lon").cast("string"),
        "temporal": "temporal",
        "date": "date",
        "time": "time",
    }
    return joined.withColumn("path", names.render_template(F.lit(template), values)).drop("version_", "temporal", "date", "time")


def full_path(relative: ColumnOrName, local: ColumnOrName, public_base: str, local_base: str | None) -> Column:
    """The path under the public base, or under the local one where ``local`` holds; null where that base is unknown."""
    base = F.when(as_col(local), F.lit(local_base)).otherwise(F.lit(public_base))
    return F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), as_col(relative))


def location_versions(versions: DataFrame) -> DataFrame:
    """(location, latest_version, n_versions) from rows (location, version); texts that are no version are left out."""
    known = versions.withColumn("v_", names.semver("version")).where("v_ is not null")
    return known.groupBy("location").agg(F.max_by("version", "v_").alias("latest_version"), F.count_distinct("version").alias("n_versions"))


def version_disagreements(versions: DataFrame) -> DataFrame:
    """Locations whose data levels do not all have one version: (location, n_levels, least, greatest)."""
    known = versions.withColumn("v_", names.semver("version"))
    out = known.groupBy("location").agg(F.count_distinct("level").alias("n_levels"), F.min_by("version", "v_").alias("least"), F.max_by("version", "v_").alias("greatest"))
    return out.where("least <> greatest")
