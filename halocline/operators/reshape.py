"""Wide tables, unions, filling and batching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILL_VALUE = -999.0


def pivot_layers(df: DataFrame, keys: list[str], values: list[str], layer: str = "sigma_layer", layers: int = 10, pattern: str = "{value}_sigma_level_{n}", first: int = 1) -> DataFrame:
    """A column per value and layer.  Conditional aggregates with a fixed list of layers: no extra job to find them."""
    cols = [F.max(F.when(F.col(layer) == k, F.col(v))).alias(pattern.format(value=v, n=k + first)) for v in values for k in range(layers)]
    return df.groupBy(*keys).agg(*cols)


def unpivot_layers(df: DataFrame, keys: list[str], value: str, layers: int = 10, pattern: str = "{value}_sigma_level_{n}", first: int = 1) -> DataFrame:
    """Back to a row per layer; no shuffle."""
    rows = F.array(*[F.struct(F.lit(k).alias("sigma_layer"), F.col(pattern.format(value=value, n=k + first)).alias(value)) for k in range(layers)])
    return df.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


def union_all(frames: dict[str, DataFrame], label: str = "location") -> DataFrame:
    """Tables of several locations under each other, columns by name, absent ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn(label, F.lit(name)) for name, df in frames.items()])


def order_columns(df: DataFrame, first: list[str], reverse: bool = True) -> DataFrame:
    """``first`` in their order, then the others, reversed by default."""
    rest = [c for c in df.columns if c not in first]
    return df.select(*first, *(reversed(rest) if reverse else rest))


def fill(df: DataFrame, columns: list[str], value: float = FILL_VALUE) -> DataFrame:
    """Null and NaN to the export's fill value."""
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(value)) for c in columns})


def last_record(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of rows with equal keys the one that comes last; a partial aggregate, so nothing is sorted."""
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("last_")).select(*keys, "last_.*")


def batch_of(index: str, size: int) -> Column:
    return F.floor(F.col(index) / size).cast("long")


def missing_batches(found: DataFrame, total: int, size: int, batch: str = "batch") -> DataFrame:
    """Batch numbers of 0 .. ceil(total / size) - 1 that are not there."""
    spark = found.sparkSession
    return spark.range(-(-total // size)).withColumnRenamed("id", batch).join(found.select(F.col(batch).cast("long").alias(batch)), batch, "left_anti")


def batch_continuity(found: DataFrame) -> DataFrame:
    """Batches whose first face does not follow the last face of the batch before."""
    from pyspark.sql import Window

    w = Window.orderBy("first")  # a row per batch file, hundreds at most
    return found.withColumn("prev_last", F.lag("last").over(w)).where(F.col("first") != F.coalesce(F.col("prev_last") + 1, F.lit(0)))
