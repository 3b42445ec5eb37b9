"""The driver's tables seen as the engine's facts and dimensions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries and SQL by name."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def put(f: Query) -> Query:
            self.queries[name] = f
            if sql:
                self.sql[name] = sql
            return f

        return put


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def velocity(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem as velocity fact: a face per supplier, a row per order line."""
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("face_id"),
        F.col("l_orderkey").alias("row_id"),
        (F.col("l_linenumber") - 1).alias("sigma_layer"),
        F.col("l_shipdate").alias("time"),
        (F.col("l_extendedprice") / 2000 - 25).alias("u"),
        (F.col("l_quantity") - 25).alias("v"),
    )


VELOCITY_SQL = """velocity AS (
    SELECT l_suppkey AS face_id, l_orderkey AS row_id, l_linenumber - 1 AS sigma_layer, l_shipdate AS time,
           l_extendedprice / 2000 - 25 AS u, l_quantity - 25 AS v FROM lineitem),
flow AS (
    SELECT *, sqrt(u * u + v * v) AS speed,
           CASE WHEN sqrt(u * u + v * v) > 0.01 THEN ((90 - degrees(atan2(v, u))) % 360 + 360) % 360 END AS to_direction,
           0.5 * 1025 * sqrt(u * u + v * v) * sqrt(u * u + v * v) * sqrt(u * u + v * v) AS power_density FROM velocity)"""


def series(spark: SparkSession, sf: str) -> DataFrame:
    """events as elevation series: a face per user."""
    return table(spark, sf, "events").select(F.col("user_id").alias("face_id"), "event_id", F.col("ts").alias("time"), (F.col("value") / 100).alias("zeta"), "event_type")


SERIES_SQL = "series AS (SELECT user_id AS face_id, event_id, ts AS time, value / 100 AS zeta, event_type FROM events)"


def points(spark: SparkSession, sf: str) -> DataFrame:
    """customers as face centres spread over the globe."""
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        key.alias("face_id"),
        F.col("c_mktsegment").alias("location"),
        F.col("c_nationkey").alias("nation"),
        (((key * 37) % 18000) / 100.0 - 90).alias("lat"),
        (((key * 91) % 36000) / 100.0 - 180).alias("lon"),
        F.col("c_acctbal").alias("value"),
    )


POINTS_SQL = """points AS (
    SELECT c_custkey AS face_id, c_mktsegment AS location, c_nationkey AS nation, ((c_custkey * 37) % 18000) / 100.0 - 90 AS lat,
           ((c_custkey * 91) % 36000) / 100.0 - 180 AS lon, c_acctbal AS value FROM customer)"""


def top_point(spark: SparkSession, sf: str) -> tuple[float, float]:
    """(lat, lon) of the point with the greatest value: where searches and lines begin that should meet something."""
    row = points(spark, sf).orderBy(F.desc("value"), "face_id").select("lat", "lon").first()
    return row.lat, row.lon


TOP_SQL = "top AS (SELECT arg_max(lat, (value, -face_id)) AS lat0, arg_max(lon, (value, -face_id)) AS lon0 FROM points)"


def end_points(spark: SparkSession, sf: str) -> tuple[tuple[float, float], tuple[float, float]]:
    """(lat, lon) of the faces with the least and the greatest id."""
    p = points(spark, sf)
    first, last = (p.orderBy(o).select("lat", "lon").first() for o in (F.asc("face_id"), F.desc("face_id")))
    return (first.lat, first.lon), (last.lat, last.lon)


ENDS_SQL = "ends AS (SELECT arg_min(lat, face_id) AS lat1, arg_min(lon, face_id) AS lon1, arg_max(lat, face_id) AS lat2, arg_max(lon, face_id) AS lon2 FROM points)"


def layers(spark: SparkSession, sf: str) -> DataFrame:
    """The first ten elements of each embedding as the sigma layers of a face."""
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("face_id"), F.col("label").alias("region"), F.posexplode(F.transform(F.slice("embedding", 1, 10), lambda x: x.cast("double"))).alias("sigma_layer", "value"))


LAYERS_SQL = """layers AS (
    SELECT vec_id AS face_id, label AS region, CAST(i - 1 AS INTEGER) AS sigma_layer, CAST(embedding[i] AS DOUBLE) AS value
    FROM embeddings, (SELECT unnest(generate_series(1, 10)) AS i))"""


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})
