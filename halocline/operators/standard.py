"""Standardising: canonical names, declared variables, units, file names, and statistics of what was derived."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halocline.functions import geo
from halocline.functions.flow import ColumnOrName, as_col
from halocline.operators.summary import percentile_name

# Canonical names of mesh dimensions and coordinates.
CANONICAL = {"nele": "face", "node": "node", "siglay": "sigma_layer", "siglev": "sigma_level", "three": "face_node_index", "latc": "lat_center", "lonc": "lon_center", "lat": "lat_node", "lon": "lon_node"}


def canonical(df: DataFrame, mapping: dict[str, str] = CANONICAL) -> DataFrame:
    """Columns under their canonical names; those without one keep theirs."""
    return df.withColumnsRenamed({a: b for a, b in mapping.items() if a in df.columns})


def declared(df: DataFrame, names: list[str]) -> DataFrame:
    """Only the declared columns, in their order; a declared column that is absent is an error."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"declared but absent: {', '.join(absent)}")
    return df.select(*names)


def unit_problems(attributes: DataFrame, keys: list[str], pair: tuple[str, str], positive: tuple[str | None, str | None] = (None, None)) -> DataFrame:
    """(keys, problem) from rows (keys, variable, units, positive): the first thing wrong with two variables that must agree."""
    a, b = pair

    def of(variable: str, column: str) -> Column:
        return F.max(F.when(F.col("variable") == variable, F.col(column)))

    wide = attributes.groupBy(*keys).agg(
        *[F.max((F.col("variable") == v).cast("int")).alias(f"has_{i}") for i, v in enumerate(pair)],
        *[of(v, c).alias(f"{c}_{i}") for i, v in enumerate(pair) for c in ("units", "positive")],
    )
    problem = F.when((F.col("has_0") == 0) | (F.col("has_1") == 0), "missing variable")
    for i, v in enumerate(pair):
        problem = problem.when(F.col(f"units_{i}").isNull(), f"{v}: units undefined")
        if positive[i]:
            problem = problem.when(F.col(f"positive_{i}").isNull(), f"{v}: positive direction undefined").when(F.col(f"positive_{i}") != positive[i], f"{v}: positive is not {positive[i]}")
    problem = problem.when(F.col("units_0") != F.col("units_1"), "units differ")
    return wide.withColumn("problem", problem).where("problem is not null").select(*keys, "problem")


def without_date(name: ColumnOrName) -> Column:
    """Whether a summary file's name has zeros for its date and time."""
    return as_col(name).rlike(r"\.b[45]\.0\.0\.")


def data_name_parts(name: ColumnOrName) -> Column:
    """struct of a name ``[number.]location.dataset[-qualifier][-step].level.date.time.ext``; null with fewer parts."""
    parts = F.split(as_col(name), r"\.")
    numbered = F.element_at(parts, 1).rlike(r"^[0-9]+$")
    part = lambda i: F.get(parts, F.when(numbered, F.lit(i + 1)).otherwise(F.lit(i)))
    step = F.regexp_extract(part(1), r"-([0-9]+[hsmHSM]z?)$", 1)
    base = F.when(step == "", part(1)).otherwise(F.regexp_replace(part(1), r"-[0-9]+[hsmHSM]z?$", ""))
    qualifier = F.regexp_extract(base, r"^[^-]*-(.*)$", 1)
    fields = {
        "prefix": F.when(numbered, F.element_at(parts, 1)),
        "location": part(0),
        "dataset": F.regexp_extract(base, r"^([^-]*)", 1),
        "qualifier": F.when(base.contains("-"), qualifier),
        "temporal": F.nullif(step, F.lit("")),
        "level": part(2),
        "date": part(3),
        "time": part(4),
        "ext": F.element_at(parts, -1),
    }
    return F.when(F.size(parts) >= 6, F.struct(*[v.alias(k) for k, v in fields.items()]))


def column_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_values, n_null, min_value, max_value, mean_value) of numeric columns, in one aggregation."""
    stats = lambda c: F.struct(F.lit(c).alias("column"), F.count(c).alias("n_values"), F.count_if(F.col(c).isNull()).alias("n_null"), F.min(c).cast("double").alias("min_value"), F.max(c).cast("double").alias("max_value"), F.avg(c).alias("mean_value"))
    return df.agg(F.array(*map(stats, columns)).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def percentile_table(df: DataFrame, keys: list[str], value: str, cap: float, percentiles: tuple[float, ...] = (0.5, 0.9, 0.95, 0.99, 0.999), most_bins: int = 60) -> DataFrame:
    """What justifies a colour scale's end: percentiles, per cent of values at or below it, and how many bins to draw."""
    v = F.col(value)
    bins = F.least(F.lit(most_bins), F.floor(F.sqrt(F.count(v)))).cast("int")
    return df.groupBy(*keys).agg(*[F.percentile(v, p).alias(f"p{percentile_name(p)}") for p in percentiles], (F.count_if(v <= cap) * 100.0 / F.count(v)).alias("retention_pct"), bins.alias("n_bins"))


def directory_sizes(files: DataFrame, depth: int) -> DataFrame:
    """(directory, n_files, total_bytes) of files (path, length), gathered at ``depth`` parts below the root."""
    parts = F.split(F.regexp_replace("path", "^/+", ""), "/")
    directory = F.array_join(F.slice(parts, F.lit(1), F.least(F.lit(depth), F.size(parts) - 1)), "/")
    return files.groupBy(directory.alias("directory")).agg(F.count("*").alias("n_files"), F.sum("length").alias("total_bytes"))


def nearest_series(points: DataFrame, fact: DataFrame, lat: float, lon: float, k: int, value: str, time: str = "time") -> DataFrame:
    """The whole series of the k nearest faces side by side: (time, value_1 .. value_k), by rank of distance.

    The k faces are a top-k of the points, so their join with the fact is with k rows.
    """
    near = points.orderBy(geo.planar_degrees(F.lit(lat), F.lit(lon), "lat", "lon"), "face_id").limit(k)
    ranked = near.withColumn("rank_", F.row_number().over(Window.orderBy(geo.planar_degrees(F.lit(lat), F.lit(lon), "lat", "lon"), "face_id"))).select("face_id", "rank_")  # k rows
    joined = fact.join(F.broadcast(ranked), "face_id")
    return joined.groupBy(time).agg(*[F.max(F.when(F.col("rank_") == i, F.col(value))).alias(f"{value}_{i}") for i in range(1, k + 1)])


def out_of_declared(df: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows with a value outside its declared limits; nulls are inside."""
    return df.where(reduce(or_, [~F.coalesce(F.col(c).between(a, b), F.lit(True)) for c, (a, b) in limits.items()]))
