"""Incremental rollups of arriving time steps with Structured Streaming.

State is bounded by a watermark; a late or repeated row within it is counted once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def first_rows(stream: DataFrame, keys: list[str], time: str = "time", lateness: str = "1 day") -> DataFrame:
    """One row per series and stamp, the first to arrive."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark([*keys, time])


def tumbling(stream: DataFrame, keys: list[str], value: str, width: str = "1 day", origin: str | None = None, time: str = "time", lateness: str = "1 day") -> DataFrame:
    """Count, mean, min and max per series and tumbling window; ``origin`` shifts the windows' start.

    Mean and extremes merge from partial states.  Percentiles do not, and stay with the batch summaries.
    """
    window = F.window(time, width, width, origin) if origin else F.window(time, width)
    marked = stream if stream.isStreaming is False else stream.withWatermark(time, lateness)
    out = marked.groupBy(*keys, window.alias("w")).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"))
    return out.select(*keys, F.col("w.start").alias("window_start"), "n", "mean", "min", "max")


def monthly(stream: DataFrame, keys: list[str], value: str, time: str = "time", lateness: str = "1 day") -> DataFrame:
    """As tumbling, per calendar month: windows have no months, so the month is a key and closes by update."""
    marked = stream if stream.isStreaming is False else stream.withWatermark(time, lateness)
    out = marked.groupBy(*keys, F.date_trunc("month", time).alias("month"))
    return out.agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"))


def write(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run what is available, then stop; a restart goes on from the checkpoint and writes nothing twice."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()


def upsert(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Updates written batch by batch into a folder of their own each, so that a batch done twice is there once."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number:08d}")

    return df.writeStream.option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).foreachBatch(put).start()


def latest_updates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Of a folder written by upsert: each key's row of its last batch."""
    others = [c for c in df.columns if c not in (*keys, "batch")]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch").alias("r")).select(*keys, "r.*")


def compact(spark: SparkSession, path: str, keys: list[str], into: str) -> DataFrame:
    """What latest_updates gives for the batches written so far, as one table at ``into``, marked with the last batch.

    Later reads take that table and the batches after it (since), so they do not read every batch ever written.
    """
    batches = spark.read.parquet(path)
    last = batches.agg(F.max("batch")).first()[0]
    latest_updates(batches, keys).withColumn("batch", F.lit(last)).write.mode("overwrite").parquet(into)
    return spark.read.parquet(into)


def since(spark: SparkSession, path: str, compacted: DataFrame, keys: list[str]) -> DataFrame:
    """Each key's last row over a compacted table and the batches that came after it; older folders are pruned."""
    done = compacted.agg(F.max("batch")).first()[0]
    newer = spark.read.parquet(path).where(F.col("batch") > done)
    return latest_updates(compacted.unionByName(newer), keys)
