"""From what a search has hit to the files that hold it: only the hit cells' folders are read.

The point layout has a folder for each 0.01-degree cell, or for the first of its keys only.  The folders of a search's
hits are told to Spark before it lists anything, so neither other folders' names nor their files are touched; inside a
file, which is sorted by the other keys, face and time, the cells, the faces and the time window skip row groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halocline.functions import names
from halocline.sources.shared import exists, first_folder

KEYS = ("lat_deg", "lon_deg", "lat_dec", "lon_dec")
KEY_SCHEMA = T.StructType([T.StructField(k, T.StringType() if "dec" in k else T.IntegerType()) for k in KEYS])
#: Up to so many cells are named one by one; hits in more cells meet the facts in a join, whose filter prunes at run time.
MOST_CELLS = 2_000
#: Up to so many faces are named, for the files' statistics.
MOST_FACES = 1_000


def hit_cells(hits: DataFrame) -> DataFrame:
    """The distinct cells (KEYS) of hits with a ``grid_id`` or with ``lat`` and ``lon``."""
    if "grid_id" in hits.columns:
        part = F.split("grid_id", "_")
        keys = [part[i].cast(f.dataType).alias(f.name) for i, f in zip((0, 1, 2, 3), KEY_SCHEMA, strict=True)]
        return hits.select(*keys).distinct()
    return hits.select(names.degree_key("lat").alias("lat_deg"), names.degree_key("lon").alias("lon_deg"), names.decimal_key("lat").alias("lat_dec"), names.decimal_key("lon").alias("lon_dec")).distinct()


def folder_keys(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The first of KEYS, those that a point store has folders for; looks into one folder of each level."""
    keys, at = [], path
    for k in KEYS:
        at = first_folder(spark, at, f"{k}=")
        if at is None:
            break
        keys.append(k)
    return tuple(keys)


def cell_folder(row: T.Row, keys: tuple[str, ...] = KEYS) -> str:
    return "/".join(f"{k}={row[k]}" for k in keys)


def in_cells(rows: DataFrame, cells: list[T.Row], keys: tuple[str, ...]) -> DataFrame:
    """Rows of these cells out of the folders by ``keys``: each further key alone reaches the files' statistics, then all count together."""
    further = KEYS[len(keys) :]
    for k in further:
        rows = rows.where(F.col(k).isin(sorted({r[k] for r in cells})))
    return rows.where(F.concat_ws("_", *KEYS).isin(["_".join(str(r[k]) for k in KEYS) for r in cells])) if further else rows


def store_schema(spark: SparkSession, path: str) -> T.StructType:
    """Columns of a point store's files with the keys as text keeps them: "07" is not 7."""
    found = spark.read.option("basePath", path).parquet(path).schema
    return T.StructType([f for f in found if f.name not in KEYS] + list(KEY_SCHEMA))


def read_hits(spark: SparkSession, path: str, hits: DataFrame, start: str | None = None, end: str | None = None, schema: T.StructType | None = None, most_cells: int = MOST_CELLS, time: str = "time") -> DataFrame:
    """Rows of a point store (``writers.write_points``) that a search's hits are about, in an inclusive time window.

    ``hits`` has faces (face_id, lat, lon), or whole cells (grid_id), as the searches return them; further columns are
    ignored, repeated hits count once, and cells without a folder have no rows.  Give ``schema`` (``store_schema``) to
    spare a listing of the whole store.
    """
    schema = schema or store_schema(spark, path)
    cells = hit_cells(hits)
    few = cells.limit(most_cells + 1).collect()
    by_face = "face_id" in hits.columns
    faces = hits.select("face_id").where("face_id IS NOT NULL").distinct() if by_face else None
    if len(few) <= most_cells:
        named, keys = [r for r in few if None not in r], folder_keys(spark, path)
        folders = [f for f in {f"{path}/{cell_folder(r, keys)}" for r in named} if exists(spark, f)]
        if not folders:
            return windowed(spark.createDataFrame([], schema), start, end, time)
        rows = in_cells(spark.read.schema(schema).option("basePath", path).parquet(*sorted(folders)), named, keys)
    else:
        rows = spark.read.schema(schema).option("basePath", path).parquet(path).join(cells, list(KEYS), "left_semi")
    rows = windowed(rows, start, end, time)
    if not by_face:
        return rows
    known = [r.face_id for r in faces.limit(MOST_FACES + 1).collect()]
    return rows.where(F.col("face_id").isin(known)) if len(known) <= MOST_FACES else rows.join(faces, "face_id", "left_semi")


def windowed(rows: DataFrame, start: str | None, end: str | None, time: str) -> DataFrame:
    kind = rows.schema[time].dataType.simpleString()
    for edge, keep in ((start, F.col(time).__ge__), (end, F.col(time).__le__)):
        if edge is not None:
            rows = rows.where(keep(F.lit(edge).cast(kind)))
    return rows


#: What describe() tells of a variable, in this order.
STATISTICS = ("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_series(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(keys, variable, count, mean, std, min, quartiles, max) of each series, a row per variable; nulls and NaN are left out.

    One aggregation for all variables; quartiles are exact, linear between values.
    """
    clean = {v: F.nanvl(F.col(v).cast("double"), F.lit(None).cast("double")) for v in values}

    def of(v: str) -> Column:
        x = clean[v]
        stats = (F.count(x), F.avg(x), F.stddev_samp(x), F.min(x), F.percentile(x, 0.25), F.percentile(x, 0.5), F.percentile(x, 0.75), F.max(x))
        return F.struct(F.lit(v).alias("variable"), *[s.alias(n) for s, n in zip(stats, STATISTICS, strict=True)])

    return rows.groupBy(*keys).agg(F.array(*map(of, values)).alias("s")).select(*keys, F.explode("s").alias("s")).select(*keys, "s.*")
