"""Monthly and yearly summaries per face (and layer).

``mode`` chooses between the documented maths ("documented") and the order-dependent results of running merges
over file buckets ("buckets").
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERCENTILES = (0.95, 0.99)


def percentile_name(p: float) -> str:
    """Distinct for .99 and .9999: 99 and 99_99."""
    return f"{p * 100:g}".replace(".", "_")


def statistics(df: DataFrame, keys: list[str], means: list[str], maxima: list[str], percentiles: tuple[float, ...] = PERCENTILES) -> DataFrame:
    """Time means, maxima and percentiles of the documented series in one aggregation."""
    aggs = [F.avg(c).alias(f"{c}_mean") for c in means]
    for c in maxima:
        aggs.append(F.max(c).alias(f"{c}_max"))
        aggs += [F.percentile(c, p).alias(f"{c}_p{percentile_name(p)}") for p in percentiles]
    return df.groupBy(*keys).agg(*aggs)


def percentile_of_bucket_maxima(df: DataFrame, keys: list[str], bucket: Column, value: str, percentiles: tuple[float, ...] = PERCENTILES) -> DataFrame:
    """Percentiles over the maxima of time buckets: two aggregations, the first much smaller than its input."""
    peaks = df.groupBy(*keys, bucket.alias("bucket_")).agg(F.max(value).alias("peak_"))
    return peaks.groupBy(*keys).agg(F.max("peak_").alias(f"{value}_max"), *[F.percentile("peak_", p).alias(f"{value}_p{percentile_name(p)}") for p in percentiles])


def column_height(df: DataFrame, keys: list[str], floor_depth: str = "sea_floor_depth") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(floor_depth).alias("water_column_height_min"), F.max(floor_depth).alias("water_column_height_max"))


def surface_layer(df: DataFrame, keys: list[str], value: str, layer: str = "sigma_layer") -> DataFrame:
    """Mean, max and percentiles of layer 0."""
    top = df.where(F.col(layer) == 0)
    return top.groupBy(*keys).agg(F.avg(value).alias(f"surface_{value}_mean"), F.max(value).alias(f"surface_{value}_max"), *[F.percentile(value, p).alias(f"surface_{value}_p{percentile_name(p)}") for p in PERCENTILES])


def running_surface_mean(df: DataFrame, keys: list[str], bucket: Column, value: str) -> DataFrame:
    """The mean that a fold over buckets gives when each bucket's rows are counted twice in its own weight."""
    parts = df.groupBy(*keys, bucket.alias("bucket_")).agg(F.avg(value).alias("mean_"), F.count(value).alias("n_"))
    ordered = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("bucket_", "mean_", "n_"))).alias("parts_"))  # one element per file bucket

    def fold(acc: Column, x: Column) -> Column:
        seen = acc["seen"] + x["n_"]
        weight = F.when(acc["seen"] == 0, F.lit(1.0)).otherwise(x["n_"] / (seen + x["n_"]))
        return F.struct((acc["mean"] * (1 - weight) + x["mean_"] * weight).alias("mean"), seen.alias("seen"))

    start = F.struct(F.lit(0.0).alias("mean"), F.lit(0).cast("long").alias("seen"))
    return ordered.select(*keys, F.aggregate("parts_", start, fold)["mean"].alias(f"surface_{value}_mean"))


def direction_bin(direction: str, width: float) -> Column:
    """Bin number from 0; 360 falls into the last bin, as a closed histogram has it."""
    return F.when(F.col(direction).isNotNull(), F.least(F.floor(F.col(direction) / width), F.lit(int(360 / width) - 1)).cast("int"))


def modal_directions(df: DataFrame, keys: list[str], direction: str, speed: str, width: float = 1.0, mask: float = 90.0) -> DataFrame:
    """Primary and secondary direction (left edges of the fullest bins) and the mean speed in each.

    The secondary is the fullest bin more than ``mask`` degrees around the circle from the primary.  Ties go to
    the lower bin.  A value of exactly 360 counts in the last bin but not in its mean speed.
    """
    bins = df.where(F.col(direction).isNotNull()).groupBy(*keys, direction_bin(direction, width).alias("bin_")).agg(F.count("*").alias("n_"), F.coalesce(F.avg(F.when(F.col(direction) < 360, F.col(speed))), F.lit(0.0)).alias("speed_"))
    w = Window.partitionBy(*keys)
    first = F.max_by("bin_", F.struct("n_", -F.col("bin_"))).over(w)
    apart = F.abs(F.col("bin_") - F.col("first_")) * width
    far = F.least(apart, 360 - apart) > mask
    order = F.struct(F.col("n_"), -F.col("bin_"))
    return (
        bins.withColumn("first_", first)
        .groupBy(*keys)
        .agg(
            (F.max("first_") * width).alias("primary_direction"),
            F.max(F.when(F.col("bin_") == F.col("first_"), F.col("speed_"))).alias("primary_speed"),
            (F.max_by("bin_", F.when(far, order)) * width).alias("secondary_direction"),
            F.max_by("speed_", F.when(far, order)).alias("secondary_speed"),
        )
    )


def gradient(value: str, keys: list[str], order: list[str]) -> Column:
    """Central differences by position, one-sided at both ends; null for a single row."""
    w = Window.partitionBy(*keys).orderBy(*order)
    before, after, here = F.lag(value).over(w), F.lead(value).over(w), F.col(value)
    return F.when(before.isNull(), after - here).when(after.isNull(), here - before).otherwise((after - before) / 2)


def flood_ebb(df: DataFrame, keys: list[str], order: list[str], direction: str, speed: str, elevation: str | None, width: float = 2.0, threshold: float = 0.5, hours_per_step: float = 0.5, slope: str | None = None) -> DataFrame:
    """Per series and for rising (flood) and falling (ebb) water: modal direction, mean speed in its bin, and hours
    at or above ``threshold`` speed.  A flat gradient is neither; a phase without rows gives zeros.

    ``slope`` is the column of the gradient where it is known; else it is taken from ``elevation``.
    """
    phased = df.withColumn("slope_", F.col(slope) if slope else gradient(elevation, keys, order)).withColumn("phase_", F.when(F.col("slope_") > 0, "flood").when(F.col("slope_") < 0, "ebb"))
    # rows of neither phase stay, so that a series without any has its row
    bins = phased.groupBy(*keys, "phase_", direction_bin(direction, width).alias("bin_")).agg(
        F.count(direction).alias("n_"),
        F.avg(F.when(F.col(direction) < 360, F.col(speed))).alias("speed_"),
        (F.count_if(F.col(speed) >= threshold) * hours_per_step).alias("hours_"),
    )
    fullest = F.struct(F.col("n_"), -F.col("bin_"))
    aggs = []
    for phase in ("flood", "ebb"):
        own = F.when((F.col("phase_") == phase) & F.col("bin_").isNotNull(), fullest)
        aggs.append(F.coalesce(F.max_by("bin_", own) * width, F.lit(0.0)).alias(f"{phase}_direction"))
        aggs.append(F.coalesce(F.max_by("speed_", own), F.lit(0.0)).alias(f"{phase}_mean_speed"))
        aggs.append(F.coalesce(F.sum(F.when(F.col("phase_") == phase, F.col("hours_"))), F.lit(0.0)).alias(f"{phase}_hours"))
    return bins.groupBy(*keys).agg(*aggs)


def depth_average(df: DataFrame, keys: list[str], columns: list[str], circular: bool = False) -> DataFrame:
    """Mean over layers of each column; directions arithmetically unless ``circular``."""
    from halocline.functions.flow import circular_mean

    return df.groupBy(*keys).agg(*[(circular_mean(c) if circular and c.endswith("direction") else F.avg(c)).alias(f"{c}_depth_avg") for c in columns])
