"""Statistics of one or several regions' summary tables."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halocline.operators.summary import percentile_name


def describe(df: DataFrame, keys: list[str], value: str, percentiles: tuple[float, ...] = (0.95, 0.99, 0.9999)) -> DataFrame:
    """Per region: exact percentiles, min, max, mean, sample deviation, rows (nulls included) and values."""
    v = F.col(value)
    quantiles = [F.percentile(v, p).alias(f"p{percentile_name(p)}") for p in percentiles]
    return df.groupBy(*keys).agg(*quantiles, F.min(v).alias("min_value"), F.max(v).alias("max_value"), F.avg(v).alias("mean_value"), F.stddev_samp(v).alias("std_value"), F.count("*").alias("n_rows"), F.count(v).alias("n_values"))


def exact_percentiles(df: DataFrame, value: str, shares: tuple[float, ...]) -> list[float | None]:
    """Exact percentiles over all rows, linear between values, without bringing all values to one task.

    Values are dealt by range and sorted; the sizes of the parts, a row for each, tell in which part and at which place the
    two values around each percentile lie, and only these are fetched.  Nulls are no values; without any all are null.
    """
    values = df.select(F.col(value).cast("double").alias("v")).where("v IS NOT NULL")
    dealt = values.repartitionByRange("v").sortWithinPartitions("v").select("v", F.spark_partition_id().alias("part"), (F.monotonically_increasing_id() % (1 << 33)).alias("place")).checkpoint()
    sizes = sorted((r.part, r.n) for r in dealt.groupBy("part").agg(F.count("*").alias("n")).collect())
    n = sum(size for _, size in sizes)
    if not n:
        return [None] * len(shares)

    def at(rank: int) -> tuple[int, int]:
        for part, size in sizes:
            if rank < size:
                return part, rank
            rank -= size
        raise AssertionError("a rank beyond all parts")

    ranks = {r for share in shares for r in (math.floor(share * (n - 1)), math.ceil(share * (n - 1)))}
    places = {rank: at(rank) for rank in ranks}
    wanted = reduce(Column.__or__, [(F.col("part") == part) & (F.col("place") == place) for part, place in places.values()])
    found = {(r.part, r.place): r.v for r in dealt.where(wanted).collect()}
    out: list[float | None] = []
    for share in shares:
        position = share * (n - 1)
        low, high = math.floor(position), math.ceil(position)
        a, b = found[places[low]], found[places[high]]
        out.append(a if a == b else (high - position) * a + (position - low) * b)
    return out


def power_statistics(df: DataFrame, value: str) -> DataFrame:
    """One row over all rows of a region."""
    v = F.col(value)
    median, p95, p99 = (F.lit(x).cast("double") for x in exact_percentiles(df, value, (0.5, 0.95, 0.99)))
    return df.agg(F.min(v).alias("min_value"), F.max(v).alias("max_value"), F.avg(v).alias("mean_value"), median.alias("median_value"), F.stddev_pop(v).alias("std_value"), p95.alias("p95"), p99.alias("p99"))


def retention(df: DataFrame, keys: list[str], value: str, cap: float) -> DataFrame:
    """Per cent of each region's values at or below ``cap``."""
    return df.groupBy(*keys).agg((F.count_if(F.col(value) <= cap) * 100.0 / F.count(value)).alias("retention_pct"), F.count(value).alias("n_values"))


def with_total(df: DataFrame, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Each region and, with nulls as its keys, all regions together, in one pass."""
    return df.rollup(*keys).agg(*aggs)


def histogram(df: DataFrame, keys: list[str], value: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts in equal bins of [low, high]; ``high`` itself is in the last bin, values outside in none."""
    step = (high - low) / bins
    number = F.least(F.floor((F.col(value) - low) / step), F.lit(bins - 1)).cast("int")
    return df.where(F.col(value).between(low, high)).groupBy(*keys, number.alias("bin")).agg(F.count("*").alias("n"))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in one aggregation: (x, y, r)."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    rows = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs])
    return wide.select(F.explode(rows).alias("c")).select("c.*")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def pooled(frames: list[DataFrame], keys: list[str], value: str) -> DataFrame:
    """Count, mean and deviation over several regions from their sums, not from their means."""
    every = reduce(DataFrame.unionByName, [f.select(*keys, value) for f in frames])
    return every.groupBy(*keys).agg(F.count(value).alias("n_values"), F.avg(value).alias("mean_value"), F.stddev_samp(value).alias("std_value"))
