"""Job manifests: files to publish, their state, and what is left to do.

Slices are cut by a fixed ``file_index``, so that changing states cannot move files between slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PENDING, COMPLETED, FAILED, SKIPPED = "pending", "completed", "failed", "skipped"


def build_manifest(files: DataFrame, order: str = "relative_path") -> DataFrame:
    """Files numbered in path order, all pending.  Numbers come from range-sorted partitions, not from one task.

    The sorted partitions are checkpointed to the folder in ``spark.checkpoint.dir``, as a partition computed again after
    a lost executor need not be cut where it was.
    """
    ranged = files.repartitionByRange(order).sortWithinPartitions(order).withColumn("part_", F.spark_partition_id()).withColumn("row_", F.monotonically_increasing_id() % (1 << 33))
    ranged = ranged.checkpoint()
    sizes = ranged.groupBy("part_").agg(F.count("*").alias("n_"))  # a row per partition
    starts = sizes.withColumn("start_", F.sum("n_").over(Window.orderBy("part_")) - F.col("n_")).drop("n_")
    out = ranged.join(F.broadcast(starts), "part_").withColumn("file_index", F.col("start_") + F.col("row_")).withColumn("upload_status", F.lit(PENDING))
    return out.drop("part_", "row_", "start_")


def update_status(manifest: DataFrame, results: DataFrame) -> DataFrame:
    """The manifest with the states and etags of ``results`` (file_index, upload_status, etag) where there are any."""
    new = results.select("file_index", F.col("upload_status").alias("new_status_"), F.col("etag").alias("new_etag_"))
    out = manifest.join(new, "file_index", "left")
    etag = F.coalesce("new_etag_", F.col("etag")) if "etag" in manifest.columns else F.col("new_etag_")
    return out.withColumn("upload_status", F.coalesce("new_status_", "upload_status")).withColumn("etag", etag).drop("new_status_", "new_etag_")


def mark_existing(manifest: DataFrame, listed: DataFrame, key: str = "s3_destination") -> DataFrame:
    """Pending files that are at their destination already become skipped."""
    there = listed.select(key).distinct().withColumn("there_", F.lit(True))
    status = F.when((F.col("upload_status") == PENDING) & F.col("there_"), SKIPPED).otherwise(F.col("upload_status"))
    return manifest.join(there, key, "left").withColumn("upload_status", status).drop("there_")


def status_summary(manifest: DataFrame, status: str = "upload_status") -> DataFrame:
    return manifest.groupBy(status).agg(F.count("*").alias("n_files"))


def batch_slice(manifest: DataFrame, batch: int, size: int, status: str | None = PENDING) -> DataFrame:
    """One task's files: those numbered in its range and still in that state, in order."""
    out = manifest.where(F.col("file_index").between(batch * size, (batch + 1) * size - 1))
    return (out.where(F.col("upload_status") == status) if status else out).orderBy("file_index")


def failed_manifest(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("upload_status") == FAILED).withColumn("upload_status", F.lit(PENDING))


def etag_mismatches(manifest: DataFrame, listed: DataFrame) -> DataFrame:
    """Completed files whose object has another etag, or none."""
    seen = listed.select("s3_destination", F.col("etag").alias("seen_etag"))
    return manifest.where(F.col("upload_status") == COMPLETED).join(seen, "s3_destination", "left").where(~F.col("etag").eqNullSafe(F.col("seen_etag")))


def jobs_needed(files: Column, per_job: int) -> Column:
    return F.ceil(files / per_job).cast("long")


def latest_version(df: DataFrame, version: str = "version") -> DataFrame:
    """The row with the highest semantic version."""
    from halocline.functions.names import semver

    return df.withColumn("v_", semver(version)).where(F.col("v_").isNotNull()).orderBy(F.desc("v_"), version).limit(1).drop("v_")
