"""Time axes: verification, de-duplication, calendars, gaps and buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Names of the two known steps.
STEP_NAMES = {3600: "1h", 1800: "30m"}


def micros(time: str = "time") -> Column:
    """Microseconds since 1970 of a timestamp, with or without a zone."""
    return F.unix_micros(F.col(time).cast("timestamp"))


def deltas(df: DataFrame, keys: list[str], time: str = "time", order: list[str] | None = None) -> DataFrame:
    """df with ``prev_time`` and ``delta_s``, the seconds since the row before in each series."""
    w = Window.partitionBy(*keys).orderBy(time, *(order or []))
    return df.withColumn("prev_time", F.lag(time).over(w)).withColumn("delta_s", (micros(time) - micros("prev_time")) / 1_000_000)


def time_report(df: DataFrame, keys: list[str], time: str = "time", order: list[str] | None = None) -> DataFrame:
    """Per series: n, first, last, duplicates, and mean, least and largest step in seconds."""
    d = deltas(df, keys, time, order)
    return d.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
        F.count_if(F.col("delta_s") == 0).alias("n_duplicates"),
        F.avg("delta_s").alias("mean_delta_s"),
        F.min("delta_s").alias("min_delta_s"),
        F.max("delta_s").alias("max_delta_s"),
    )


def bad_pairs(df: DataFrame, keys: list[str], expected_s: float, tolerance_s: float = 0.001, time: str = "time", order: list[str] | None = None) -> DataFrame:
    """Neighbouring stamps whose distance is not the expected step."""
    d = deltas(df, keys, time, order)
    return d.where(F.abs(F.col("delta_s") - expected_s) > tolerance_s).select(*keys, "prev_time", time, "delta_s")


def order_violations(df: DataFrame, keys: list[str], position: str, time: str = "time") -> DataFrame:
    """Rows whose stamp is before that of the row before them in ``position``."""
    w = Window.partitionBy(*keys).orderBy(position)
    return df.withColumn("prev_time", F.lag(time).over(w)).where(F.col(time) < F.col("prev_time"))


def coverage(df: DataFrame, keys: list[str], start: str, end: str, time: str = "time") -> DataFrame:
    """Per series, whether it reaches from ``start`` to ``end``."""
    first, last = F.min(time), F.max(time)
    return df.groupBy(*keys).agg(((first <= F.lit(start).cast("timestamp_ntz")) & (last >= F.lit(end).cast("timestamp_ntz"))).alias("covers"))


def step_name(seconds: Column) -> Column:
    """``1h`` or ``30m``; null for any other step."""
    out = None
    for s, name in STEP_NAMES.items():
        out = (F if out is None else out).when(F.abs(seconds - s) < 0.001, name)
    return out


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row of each key, the first in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank_", F.row_number().over(w)).where("rank_ = 1").drop("rank_")


def clip(df: DataFrame, start: str, end: str, time: str = "time") -> DataFrame:
    """Rows from start to end, both included; the literals' type follows the column, so the scan can prune."""
    kind = df.schema[time].dataType.simpleString()
    return df.where(F.col(time).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def calendar(spark: SparkSession, start: str, end: str, step_s: int, time: str = "time") -> DataFrame:
    """All stamps from start to end, distributed."""
    kind = "timestamp_ntz"
    return spark.sql(f"select explode(sequence(cast('{start}' as {kind}), cast('{end}' as {kind}), make_dt_interval(0, 0, 0, {step_s}))) as {time}")


def pad(df: DataFrame, keys: list[str], stamps: DataFrame, time: str = "time") -> DataFrame:
    """A row for every key and stamp of the calendar, with nulls where ``df`` has none.

    The calendar is a year of steps at most (under 20,000 rows), so it is sent to the keys as an array and
    exploded there; the join with the data is on keys and time.
    """
    every = stamps.agg(F.sort_array(F.collect_list(time)).alias("stamps_"))
    grid = df.select(*keys).distinct().crossJoin(F.broadcast(every)).select(*keys, F.explode("stamps_").alias(time))
    return grid.join(df, [*keys, time], "left")


def missing(df: DataFrame, keys: list[str], stamps: DataFrame, time: str = "time") -> DataFrame:
    """(keys, time) that the calendar has and ``df`` lacks."""
    every = stamps.agg(F.sort_array(F.collect_list(time)).alias("stamps_"))
    grid = df.select(*keys).distinct().crossJoin(F.broadcast(every)).select(*keys, F.explode("stamps_").alias(time))
    return grid.join(df.select(*keys, time).distinct(), [*keys, time], "left_anti")


def islands(df: DataFrame, keys: list[str], index: str) -> DataFrame:
    """Runs of consecutive integers: (keys, first, last, n)."""
    w = Window.partitionBy(*keys).orderBy(index)
    return df.withColumn("run_", F.col(index) - F.row_number().over(w)).groupBy(*keys, "run_").agg(F.min(index).alias("first"), F.max(index).alias("last"), F.count("*").alias("n")).drop("run_")


def index_ranges(df: DataFrame, keys: list[str], index: str) -> DataFrame:
    """Consecutive integers written as ``a-b,c``."""
    part = F.when(F.col("first") == F.col("last"), F.col("first").cast("string")).otherwise(F.concat_ws("-", "first", "last"))
    runs = islands(df, keys, index).withColumn("part", part)
    return runs.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "part"))), lambda x: x["part"]), ",").alias("ranges"))


def day_bucket(time: str = "time") -> Column:
    return F.date_trunc("day", F.col(time))


def month_bucket(time: str = "time") -> Column:
    return F.date_trunc("month", F.col(time))


def n_day_bucket(days: int, origin: str, time: str = "time") -> Column:
    """First day of the bucket of ``days`` days counted from the day ``origin``."""
    since = F.datediff(F.col(time), F.lit(origin).cast("date"))
    return F.date_add(F.lit(origin).cast("date"), (F.floor(since / days) * days).cast("int"))
