"""Reading facts and dimensions: file lists, hive layouts, versions and schemas.

NetCDF, HDF5 and shapefiles are converted to Parquet outside; the schemas here are the exchange format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halocline.functions import names

SCHEMAS = {
    "face": "location string, face_id long, lat_center double, lon_center double, h_center float, timezone_offset short, distance_to_shore float, jurisdiction string, mean_navd88_offset float, grid_resolution float",
    "node": "location string, node_id long, lat_node float, lon_node float, x float, y float",
    "face_node": "location string, face_id long, corner int, node_id long",
    "velocity": "location string, face_id long, time timestamp, sigma_layer int, u float, v float",
    "zeta": "location string, node_id long, time timestamp, zeta float",
}


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[name])


def list_files(spark: SparkSession, path: str, pattern: str = "*", exclude: list[str] | None = None) -> DataFrame:
    """(path, name, modified, length) of the files below a folder, without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    out = files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("modificationTime").alias("modified"), "length")
    return out.where(~F.col("name").isin(exclude)) if exclude else out


def newest(files: DataFrame, prefer: str | None = None) -> DataFrame:
    """The file modified last, those whose name has ``prefer`` first."""
    first = F.col("name").contains(prefer) if prefer else F.lit(True)
    return files.orderBy(F.desc(first), F.desc("modified"), "path").limit(1)


def partition_files(files: DataFrame) -> DataFrame:
    """Point files with the face, position and keys that their path tells."""
    parsed = files.withColumn("f_", names.parse_point_file("name")).withColumn("p_", names.parse_partition_path("path"))
    return parsed.where(F.col("f_").isNotNull() & F.col("p_").isNotNull()).select(*files.columns, "f_.*", "p_.*")


def read_fact(spark: SparkSession, path: str | list[str], name: str) -> DataFrame:
    """A fact or dimension with its declared schema; NaN becomes null in floating columns."""
    df = spark.read.schema(schema(name)).parquet(*([path] if isinstance(path, str) else path))
    return df.withColumns({f.name: F.when(~F.isnan(f.name), F.col(f.name)) for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))})


def read_points(spark: SparkSession, path: str, lat_deg: int | None = None, lon_deg: int | None = None) -> DataFrame:
    """A point-partitioned dataset; the keys prune folders.  Decimal keys keep their leading zeros."""
    df = spark.read.option("basePath", path).parquet(path)
    for key, value in (("lat_deg", lat_deg), ("lon_deg", lon_deg)):
        if value is not None:
            df = df.where(F.col(key) == value)
    return df


def read_region(spark: SparkSession, path: str, periods: list[str]) -> DataFrame:
    """A region's summary with tidal periods in hours."""
    df = spark.read.parquet(path)
    return df.withColumns({c: F.col(c) / 3600 for c in periods if c in df.columns})


def schema_problems(df: DataFrame, required: T.StructType) -> list[tuple[str, str]]:
    """(column, problem) of what a table lacks of a declared schema; floats may be wider than declared."""
    have = {f.name: f.dataType for f in df.schema}
    wide = {T.FloatType(): (T.FloatType(), T.DoubleType())}
    out = []
    for f in required:
        if f.name not in have:
            out.append((f.name, "missing"))
        elif have[f.name] not in wide.get(f.dataType, (f.dataType,)):
            out.append((f.name, f"{have[f.name].simpleString()} for {f.dataType.simpleString()}"))
    return out


def read_hotspots(spark: SparkSession, path: str) -> DataFrame:
    from halocline.sources.writers import HOTSPOTS

    return spark.read.schema(HOTSPOTS).option("header", True).csv(path)


def fact_sizes(fact: DataFrame, face: str = "face_id", time: str = "time") -> DataFrame:
    """(n_faces, n_times, n_rows) of a fact, in one aggregation."""
    return fact.agg(F.count_distinct(face).alias("n_faces"), F.count_distinct(time).alias("n_times"), F.count("*").alias("n_rows"))
