"""Incremental extraction of faces' series from many source files.

An extraction is a folder.  ``runs/<name>`` holds the rows that a run has taken from files, ``done/<name>`` which faces it
took from which version of which file; it is written last, so a run counts when its ``done`` is complete, and the rows of
a run that died are never read.  A later run takes only pairs of file and face that no earlier one has: new files, changed
files (another length or time of change), and new faces in old files.  What is taken from a file that changed later gives
way to the newer rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halocline.operators.spatial import k_nearest
from halocline.sources.shared import exists, finished

DONE = "file string, version string, face_id long"
TARGETS = "lat double, lon double, k int, faces array<long>"


def versions(files: DataFrame) -> DataFrame:
    """(file, version) of listed files (path, modified, length)."""
    return files.select(F.col("path").alias("file"), F.concat_ws("-", F.col("length"), F.unix_micros("modified")).alias("version"))


class Extraction:
    """Series of chosen faces, gathered from a set of Parquet files that grows and changes."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def done(self) -> DataFrame:
        """(file, version, face_id, run) of all runs that came to their end."""
        runs = finished(self.spark, f"{self.path}/done")
        if not runs:
            return self.spark.createDataFrame([], f"{DONE}, run string")
        every = self.spark.read.schema(DONE).parquet(*[f"{self.path}/done/{r}" for r in runs])
        return every.withColumn("run", F.regexp_extract("_metadata.file_path", r"/done/([^/]+)/", 1))

    def pending(self, files: DataFrame, faces: list[int]) -> DataFrame:
        """(file, version, face_id) that no run has taken yet."""
        wanted = versions(files).withColumn("face_id", F.explode(F.array(*[F.lit(f).cast("long") for f in faces])))
        return wanted.join(self.done().drop("run"), ["file", "version", "face_id"], "left_anti")

    def run(self, files: DataFrame, faces: list[int], columns: list[str] | None = None) -> list[str]:
        """Take what is pending of ``faces``, a list as for a report, from listed files; returns the files that were read.

        The driver holds the names of the files to read, as any scan does.
        """
        if not faces:
            return []
        todo = self.pending(files, faces).checkpoint()
        read = sorted(r.file for r in todo.select("file").distinct().collect())
        if not read:
            return []
        name = uuid.uuid4().hex
        rows = self.spark.read.parquet(*read).select("*", F.col("_metadata.file_path").alias("file"))
        rows = rows.where(F.col("face_id").isin(faces))  # reaches the files' statistics
        if columns is not None:
            rows = rows.select("face_id", "time", *columns, "file")
        taken = plain(rows).withColumn("face_id", F.col("face_id").cast("long")).join(plain(todo), ["file", "face_id"])
        taken.write.parquet(f"{self.path}/runs/{name}")
        todo.write.parquet(f"{self.path}/done/{name}")
        return read

    def run_nearest(self, points: DataFrame, files: DataFrame, lat: float, lon: float, k: int = 10, columns: list[str] | None = None) -> list[str]:
        """The same for the ``k`` faces nearest to a position, which is noted with them."""
        faces = [r.face_id for r in k_nearest(points, lat, lon, k).select(F.col("face_id").cast("long")).collect()]
        read = self.run(files, faces, columns)
        target = self.spark.createDataFrame([(float(lat), float(lon), k, faces)], TARGETS)
        target.write.mode("append").parquet(f"{self.path}/targets")
        return read

    def series(self) -> DataFrame:
        """All rows of the newest version of each file, one per face and time; of several files with it the last by name."""
        done = self.done()
        runs = finished(self.spark, f"{self.path}/done")
        if not runs:
            raise ValueError("nothing is extracted yet")
        rows = self.spark.read.option("mergeSchema", True).parquet(*[f"{self.path}/runs/{r}" for r in runs if exists(self.spark, f"{self.path}/runs/{r}")])
        newest = done.groupBy("file").agg(F.max_by("version", F.split("version", "-")[1].cast("long")).alias("version"))
        kept = rows.join(plain(newest), ["file", "version"], "left_semi")
        others = [c for c in kept.columns if c not in ("face_id", "time", "file", "version")]
        one = kept.groupBy("face_id", "time").agg(F.max_by(F.struct(*others), F.struct("file", *others)).alias("r") if others else F.count("*").alias("r"))
        return one.select("face_id", "time", "r.*") if others else one.select("face_id", "time")

    def targets(self) -> DataFrame:
        """What was asked for: (lat, lon, k, faces) of each run by position."""
        return self.spark.read.schema(TARGETS).parquet(f"{self.path}/targets") if exists(self.spark, f"{self.path}/targets") else self.spark.createDataFrame([], TARGETS)


def plain(df: DataFrame) -> DataFrame:
    """File names as Spark tells them of rows, without spelling differences of the scheme."""
    return df.withColumn("file", F.regexp_replace("file", r"^file:/+", "file:///"))
