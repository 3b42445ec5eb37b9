"""Data quality as tables of violations: an empty result means that all is well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halocline.functions import names


def out_of_range(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Rows whose position is not finite or not on the globe."""
    bad = lambda c, limit: F.col(c).isNull() | F.isnan(c) | ~F.col(c).between(-limit, limit)
    return df.where(bad(lat, 90.0) | bad(lon, 180.0))


def not_close(a: Column, b: Column, rtol: float = 1e-6, atol: float = 1e-8) -> Column:
    """The usual closeness with absolute and relative tolerance, two nulls being close."""
    return ~F.coalesce(F.abs(a - b) <= atol + rtol * F.abs(b), a.isNull() & b.isNull())


def differs_from_first(df: DataFrame, keys: list[str], source: str, columns: list[str], rtol: float = 0.0, atol: float = 0.0) -> DataFrame:
    """(source, keys) whose coordinates differ from those of the first source, or that it lacks.

    The first source's table is one of many, so it is the small side of a keyed join.
    """
    first = df.agg(F.min(source).alias("first_"))
    base = df.join(F.broadcast(first), F.col(source) == F.col("first_")).select(*keys, *[F.col(c).alias(f"{c}_first") for c in columns], F.lit(True).alias("there_"))
    joined = df.join(base, keys, "left")
    bad = F.col("there_").isNull()
    for c in columns:
        bad = bad | not_close(F.col(c), F.col(f"{c}_first"), rtol, atol)
    return joined.where(bad).select(source, *keys)


def not_constant(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Keys for which a column that should be constant has several values; least and greatest instead of sets."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | ~F.min(c).eqNullSafe(F.max(c)) | (F.count(c) % F.count("*") != 0)
    return df.groupBy(*keys).agg(bad.alias("bad_")).where("bad_").drop("bad_")


def attribute_changes(before: DataFrame, after: DataFrame, keys: list[str], attrs: str, allowed: list[str], degree_tolerance: float = 1e-4) -> DataFrame:
    """(keys, attribute, old, new) of MAP columns, but for allowed names and for ``geospatial_`` numbers and polygons within
    the tolerance: polygons of as many corners, each of them no farther off along either axis."""
    rows = lambda df, name: df.select(*keys, F.explode(attrs).alias("attribute", name))
    both = rows(before, "old").join(rows(after, "new"), [*keys, "attribute"], "full")
    near = F.col("attribute").startswith("geospatial_") & (F.abs(F.expr("try_cast(old as double)") - F.expr("try_cast(new as double)")) <= degree_tolerance)
    a, b = names.parse_wkt_polygon("old"), names.parse_wkt_polygon("new")
    off = F.zip_with(a, b, lambda p, q: F.greatest(F.abs(p["lon"] - q["lon"]), F.abs(p["lat"] - q["lat"])))
    same_ring = F.col("attribute").startswith("geospatial_") & (F.size(a) == F.size(b)) & F.forall(off, lambda d: F.coalesce(d <= degree_tolerance, F.lit(False)))
    near = F.coalesce(near, F.lit(False)) | F.coalesce(same_ring, F.lit(False))
    return both.where(~F.col("old").eqNullSafe(F.col("new")) & ~near & ~F.col("attribute").isin(allowed))


def missing_required(df: DataFrame, required: DataFrame, on: list[str]) -> DataFrame:
    """Declared rows that are not there."""
    return required.join(df.select(*on).distinct(), on, "left_anti")


def null_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_null) for columns with nulls or NaN, in one pass."""
    kinds = dict(df.dtypes)
    count = lambda c: F.count_if(F.col(c).isNull() | (F.isnan(c) if kinds[c] in ("double", "float") else F.lit(False)))
    wide = df.agg(*[count(c).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in columns])
    return wide.select(F.explode(rows).alias("r")).select("r.*").where("n_null > 0")


def vertical_extent(df: DataFrame, depth: str, zeta: str) -> DataFrame:
    """Greatest depth and, as a height, the negative of the greatest elevation."""
    return df.agg(F.max(depth).alias("vertical_max"), (-F.max(zeta)).alias("vertical_min"))
