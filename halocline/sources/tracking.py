"""Verification with a memory: files are checked once for each content and set of rules.

A tracking folder has ``runs/<name>`` with the problems that a run has found and ``done/<name>`` with the files it has
checked, their version (length and time of change) and the version of the rules; ``done`` is written last.  A file is
checked again when it has changed or the rules have, and only then.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halocline.sources.extract import plain, versions
from halocline.sources.shared import finished

DONE = "file string, version string, rules string, checked_at timestamp"
PROBLEMS = "file string, version string, rules string, check string, detail string"

#: From the rows of files, with the file's name in the column ``file``, to problems (file, check, detail).
Check = Callable[[DataFrame], DataFrame]


class Tracking:
    def __init__(self, spark: SparkSession, path: str, rules: str) -> None:
        self.spark, self.path, self.rules = spark, path.rstrip("/"), rules

    def read(self, table: str, schema: str) -> DataFrame:
        runs = finished(self.spark, f"{self.path}/done")
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{table}/{r}" for r in runs]) if runs else self.spark.createDataFrame([], schema)

    def done(self) -> DataFrame:
        return self.read("done", DONE)

    def pending(self, files: DataFrame) -> DataFrame:
        """(file, version) of listed files that these rules have not seen in this version."""
        return versions(files).join(self.done().where(F.col("rules") == self.rules), ["file", "version"], "left_anti")

    def verify(self, files: DataFrame, checks: dict[str, Check]) -> list[str]:
        """Run all checks over the rows of the pending files, all at once; returns the files that were read."""
        todo = self.pending(files).checkpoint()
        read = sorted(r.file for r in todo.select("file").collect())
        if not read:
            return []
        rows = plain(self.spark.read.parquet(*read).select("*", F.col("_metadata.file_path").alias("file")))
        empty = self.spark.createDataFrame([], "file string, check string, detail string")
        found = empty
        for name, check in checks.items():
            found = found.unionByName(check(rows).select("file", F.lit(name).alias("check"), F.col("detail").cast("string").alias("detail")))
        named = found.join(plain(todo).withColumn("rules", F.lit(self.rules)), "file").select("file", "version", "rules", "check", "detail")
        name = uuid.uuid4().hex
        named.write.parquet(f"{self.path}/runs/{name}")
        todo.select("file", "version", F.lit(self.rules).alias("rules"), F.current_timestamp().alias("checked_at")).write.parquet(f"{self.path}/done/{name}")
        return read

    def problems(self, files: DataFrame) -> DataFrame:
        """What these rules have found in the listed files as they are now."""
        now = plain(versions(files))
        return self.read("runs", PROBLEMS).where(F.col("rules") == self.rules).join(now, ["file", "version"], "left_semi")

    def unverified(self, files: DataFrame) -> DataFrame:
        return self.pending(files).select("file")


# ---------------------------------------------------------------- checks


def step_check(step_s: float, time: str = "time", keys: tuple[str, ...] = ("face_id",)) -> Check:
    """Files in which a series does not go on by equal steps; detail is the number of series and the first step that is off."""

    def check(rows: DataFrame) -> DataFrame:
        from pyspark.sql import Window

        stamp = F.unix_micros(F.col(time).cast("timestamp")) / 1e6
        step = stamp - F.lag(stamp).over(Window.partitionBy("file", *keys).orderBy(time))
        off = rows.withColumn("step_", step).where(F.col("step_") != step_s).withColumn("key_", F.struct(*keys))
        return off.groupBy("file").agg(F.concat_ws(" series, first step ", F.count_distinct("key_"), F.min_by("step_", F.struct(time, *keys))).alias("detail"))

    return check


def range_check(limits: dict[str, tuple[float, float]]) -> Check:
    """Files with values beyond limits (inclusive), by variable with their number; nulls are no values."""

    def check(rows: DataFrame) -> DataFrame:
        counts = [F.count_if(~F.col(c).between(*lim)).alias(c) for c, lim in limits.items()]
        each = F.array(*[F.when(F.col(c) > 0, F.concat(F.lit(f"{c}: "), F.col(c))) for c in limits])
        found = rows.groupBy("file").agg(*counts).withColumn("detail", F.array_join(F.filter(each, lambda x: x.isNotNull()), ", "))
        return found.where("detail <> ''").select("file", "detail")

    return check


def face_set_check(reference: DataFrame, face: str = "face_id") -> Check:
    """Files whose faces are not just those of ``reference``: how many are missing and how many are strange.

    Faces of a file are compared as sets: a join on face and two counts, none of it by the file's rows.
    """

    def check(rows: DataFrame) -> DataFrame:
        own = rows.select("file", face).distinct()
        wanted = reference.select(face).distinct()
        total = wanted.count()
        met = own.join(wanted.withColumn("known_", F.lit(True)), face, "left").groupBy("file").agg(F.count("known_").alias("known"), F.count("*").alias("n"))
        out = met.withColumn("missing", F.lit(total) - F.col("known")).withColumn("strange", F.col("n") - F.col("known"))
        return out.where("missing > 0 OR strange > 0").select("file", F.concat(F.col("missing"), F.lit(" missing, "), F.col("strange"), F.lit(" strange")).alias("detail"))

    return check


def refuse_leftovers(batches: DataFrame, total: int, size: int, batch: str = "batch") -> None:
    """An error if the batches on disk are not just those of a run: left over from one with other sizes, or missing."""
    expected = -(-total // size)
    stray = [r[0] for r in batches.where(~F.col(batch).between(0, expected - 1)).select(batch).distinct().orderBy(batch).limit(5).collect()]
    have = batches.where(F.col(batch).between(0, expected - 1)).select(batch).distinct().count()
    if stray or have != expected:
        raise ValueError(f"{expected} batches expected, {expected - have} are missing; left over from another run: {stray}")
