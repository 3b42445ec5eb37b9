"""Writing summaries, point partitions, manifests and exports."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halocline.functions import names
from halocline.operators import reshape

# Compression by purpose.
COMPRESSION = {"none": "uncompressed", "standard": "snappy", "archival": "zstd"}


def to_float32(df: DataFrame) -> DataFrame:
    """Doubles are stored as floats; sums are made before."""
    return df.withColumns({f.name: F.col(f.name).cast("float") for f in df.schema if f.dataType == T.DoubleType()})


def write_summary(df: DataFrame, path: str, strategy: str = "standard", mode: str = "errorifexists") -> None:
    to_float32(df).write.mode(mode).option("compression", COMPRESSION[strategy]).parquet(path)


def write_points(df: DataFrame, path: str, max_rows: int = 5_000_000, mode: str = "overwrite", folders: int = 4) -> None:
    """Time series laid out by 0.01-degree cell.

    Rows are range-partitioned by cell, face and time: a cell's rows meet in few files, a crowded cell is spread
    over several tasks, and every file is sorted by face and time, so that its statistics prune.

    The first ``folders`` of the four keys are folders, the others columns of the files, which are sorted by them.  A file
    costs some 35 ms of a task and a rename on the driver whatever its rows, so cells of few rows want fewer levels: one,
    whole degrees of latitude, makes 181 folders at most, and files by the tasks that share one.
    """
    keyed = df.withColumns({"lat_deg": names.degree_key("lat"), "lon_deg": names.degree_key("lon"), "lat_dec": names.decimal_key("lat"), "lon_dec": names.decimal_key("lon")})
    keys = ["lat_deg", "lon_deg", "lat_dec", "lon_dec"]
    laid = keyed.repartitionByRange(*keys, "face_id", "time").sortWithinPartitions(*keys, "face_id", "time")
    laid.write.mode(mode).option("maxRecordsPerFile", max_rows).partitionBy(*keys[:folders]).parquet(path)


def write_manifest(index: DataFrame, points: DataFrame, path: str) -> None:
    """Cell index and nested point lists as JSON lines."""
    index.write.mode("overwrite").json(f"{path}/grid_index")
    points.write.mode("overwrite").json(f"{path}/grid_points")


def write_daily(df: DataFrame, path: str, time: str = "time", skip_existing: bool = True) -> None:
    """One folder a day, compressed for the archive; days that are there already are left as they are."""
    spark = df.sparkSession
    dated = df.withColumn("day", F.to_date(time))
    if skip_existing:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            done = spark.read.parquet(path).select("day").distinct()
            dated = dated.join(done, "day", "left_anti")
    dated.repartitionByRange("day", time).sortWithinPartitions("day", time).write.mode("append").option("compression", COMPRESSION["archival"]).partitionBy("day").parquet(path)


HOTSPOTS = "rank int, face_id long, lat double, lon double, value double, spacing_m double"


def write_hotspots(spots: DataFrame, path: str) -> None:
    """A report's few rows as one CSV file with a header."""
    spots.orderBy("rank").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def geojson_features(df: DataFrame, ring: str, properties: list[str]) -> DataFrame:
    """One GeoJSON feature per row as text; ``ring`` is a closed array of (lon, lat)."""
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(F.transform(ring, lambda p: F.array(p["lon"], p["lat"]))).alias("coordinates"))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties"))).alias("value"))


def wkt_polygon(ring: str) -> Column:
    """Well-known text of one closed ring."""
    points = F.transform(ring, lambda p: F.format_string("%.6f %.6f", p["lon"], p["lat"]))
    return F.concat(F.lit("POLYGON (("), F.array_join(points, ", "), F.lit("))"))


@F.pandas_udf(T.BinaryType())
def wkb_ring(rings: pd.Series) -> pd.Series:
    """Well-known binary, little-endian, of polygons of one closed ring (lon, lat); null for a null ring."""

    def one(ring) -> bytes | None:
        if ring is None:
            return None
        points = np.array([(p["lon"], p["lat"]) for p in ring], "<f8").reshape(-1, 2)
        return b"\x01" + np.array([3, 1, len(points)], "<u4").tobytes() + points.tobytes()

    return rings.map(one)


def write_wkb(df: DataFrame, ring: str, path: str, mode: str = "errorifexists") -> None:
    """A table with its ring as ``geometry`` in well-known binary, as readers of geographic Parquet take it."""
    df.withColumn("geometry", wkb_ring(ring)).drop(ring).write.mode(mode).parquet(path)


def export_wide(df: DataFrame, keys: list[str], values: list[str], layers: int = 10) -> DataFrame:
    """Layered values as two-digit columns from 01, gaps as the fill value, stamps as fixed-width text."""
    wide = reshape.pivot_layers(df, keys, values, layers=layers, pattern="{value}_sigma_layer_{n:02d}")
    filled = reshape.fill(wide, [c for c in wide.columns if c not in keys])
    return filled.withColumn("time_index", names.hsds_time("time")) if "time" in keys else filled


def row_group_rows(n_faces: int, n_steps: int, bytes_per_value: int = 4, target_mb: float = 6.4) -> int:
    """Faces per chunk: a multiple of 100 near the target size, all of them when they are few."""
    fit = int(target_mb * 1e6 / max(n_steps * bytes_per_value, 1))
    return n_faces if n_faces <= max(fit, 100) else max(fit // 100 * 100, 100)
