"""Attributes of a dataset and its variables, kept as field metadata in Spark schemas and in the footers of Parquet files.

Spark writes the metadata of fields into each footer and reads it back, so attributes go with a table through selections,
filters and joins.  Expressions make new fields without any: ``carry`` gives them back.  Attributes of the dataset as a
whole are kept with its first field.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DATASET = "dataset_attributes"

Attributes = dict[str, object]


def with_attributes(df: DataFrame, variables: dict[str, Attributes] | None = None, dataset: Attributes | None = None) -> DataFrame:
    """``df`` with attributes; they are merged into those it has, and new values go before old ones.

    A variable that is no column is an error.  A value of None takes an attribute away.
    """
    old_dataset, old = attributes_of(df)
    unknown = set(variables or {}) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    whole = merged(old_dataset, dataset or {})
    out = df
    for k, name in enumerate(df.columns):
        own = merged(old.get(name, {}), (variables or {}).get(name, {}))
        if k == 0 and whole:
            own = own | {DATASET: whole}
        if own != df.schema[name].metadata:
            out = out.withMetadata(name, own)
    return out


def merged(old: Attributes, new: Attributes) -> Attributes:
    return {k: v for k, v in (old | new).items() if v is not None}


def attributes_of(df: DataFrame) -> tuple[Attributes, dict[str, Attributes]]:
    """(attributes of the dataset, those of each variable that has any)."""
    dataset: Attributes = {}
    variables: dict[str, Attributes] = {}
    for f in df.schema:
        own = dict(f.metadata)
        dataset |= own.pop(DATASET, {})
        own.pop("__CHAR_VARCHAR_TYPE_STRING", None)
        if own:
            variables[f.name] = own
    return dataset, variables


def carry(df: DataFrame, like: DataFrame, renamed: dict[str, str] | None = None) -> DataFrame:
    """``df`` with the attributes of ``like``: of columns of the same name, and of ``renamed`` ones (new name to old)."""
    dataset, variables = attributes_of(like)
    own = {c: variables[(renamed or {}).get(c, c)] for c in df.columns if (renamed or {}).get(c, c) in variables}
    return with_attributes(df, own, dataset)


def attribute_table(df: DataFrame) -> DataFrame:
    """(variable, attribute, value) of all attributes, those of the dataset under an empty name; values as text."""
    dataset, variables = attributes_of(df)
    rows = [(v, a, text_of(x)) for v, own in [("", dataset), *variables.items()] for a, x in own.items()]
    return df.sparkSession.createDataFrame(rows, "variable string, attribute string, value string")


def text_of(value: object) -> str:
    return value if isinstance(value, str) else json.dumps(value)


def structure(df: DataFrame) -> DataFrame:
    """(position, variable, type, nullable, n_attributes): the structure of a table as rows, for a listing or to compare."""
    _, variables = attributes_of(df)
    rows = [(k, f.name, f.dataType.simpleString(), f.nullable, len(variables.get(f.name, {}))) for k, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, variable string, type string, nullable boolean, n_attributes int")


def structure_changes(a: DataFrame, b: DataFrame) -> DataFrame:
    """(variable, what, before, after) of what differs between the structures and attributes of two tables."""
    return differences(a.sparkSession, facts(a), facts(b))


def facts(df: DataFrame) -> dict[tuple[str, str], str]:
    dataset, variables = attributes_of(df)
    out = {(f.name, "type"): f.dataType.simpleString() for f in df.schema}
    out |= {(v, f"attribute {a}"): text_of(x) for v, own in [("", dataset), *variables.items()] for a, x in own.items()}
    return out


def differences(spark: SparkSession, a: dict, b: dict) -> DataFrame:
    rows = [(*k, a.get(k), b.get(k)) for k in sorted(a.keys() | b.keys()) if a.get(k) != b.get(k)]
    return spark.createDataFrame(rows, "variable string, what string, before string, after string")


def find_variables(df: DataFrame, attribute: str, value: str) -> list[str]:
    """Columns whose attribute has a value, such as a standard name or a unit."""
    return [v for v, own in attributes_of(df)[1].items() if text_of(own.get(attribute, "")) == value]


def bounds(df: DataFrame, lat: str = "lat", lon: str = "lon", time: str | None = "time", depth: str | None = None, step_s: float | None = None) -> Attributes:
    """Attributes that tell where and when a dataset lies, in one aggregation.

    Longitudes west of the date line are counted on beyond 180 degrees if that makes the span smaller, so a region across
    it has its own width and not that of the globe.  Without rows there are none.
    """
    east = F.when(F.col(lon) < 0, F.col(lon) + 360.0).otherwise(F.col(lon))
    asked = {"a": F.min(lat), "b": F.max(lat), "c": F.min(lon), "d": F.max(lon), "e": F.min(east), "f": F.max(east)}
    if time:
        stamp = F.col(time).cast("timestamp")
        asked |= {"s": F.date_format(F.min(stamp), "yyyy-MM-dd'T'HH:mm:ss'Z'"), "t": F.date_format(F.max(stamp), "yyyy-MM-dd'T'HH:mm:ss'Z'"), "n": (F.unix_micros(F.max(stamp)) - F.unix_micros(F.min(stamp))) / 1e6}
    if depth:
        asked |= {"u": F.min(depth), "v": F.max(depth)}
    r = df.agg(*[v.cast("double").alias(k) if k in "abcdefuvn" else v.alias(k) for k, v in asked.items()]).first()
    if r.a is None:
        return {}
    low, high = (r.e, r.f) if r.f - r.e < r.d - r.c else (r.c, r.d)
    out: Attributes = {"geospatial_lat_min": r.a, "geospatial_lat_max": r.b, "geospatial_lat_units": "degrees_north", "geospatial_lon_min": low, "geospatial_lon_max": high, "geospatial_lon_units": "degrees_east"}
    if time:
        out |= {"time_coverage_start": r.s, "time_coverage_end": r.t, "time_coverage_duration_s": r.n}
        out |= {"time_coverage_resolution_s": step_s} if step_s is not None else {}
    if depth:
        out |= {"geospatial_vertical_min": r.u, "geospatial_vertical_max": r.v, "geospatial_vertical_positive": "down"}
    return out


#: What does not hold for a part of a dataset, such as one point's file.
NOT_OF_PARTS = ("geospatial_bounds", "geospatial_bounds_crs", "geospatial_lat_min", "geospatial_lat_max", "geospatial_lon_min", "geospatial_lon_max", "input_history_json")


def for_parts(dataset: Attributes) -> Attributes:
    return {k: v for k, v in dataset.items() if k not in NOT_OF_PARTS}


def missing_attributes(df: DataFrame, required: dict[str, Attributes]) -> list[tuple[str, str, str | None, str]]:
    """(variable, attribute, has, should have) of required attributes that a table lacks; under "" those of the dataset."""
    dataset, variables = attributes_of(df)
    have = variables | {"": dataset}
    return [(v, a, text_of(have.get(v, {})[a]) if a in have.get(v, {}) else None, text_of(x)) for v, own in required.items() for a, x in own.items() if have.get(v, {}).get(a) != x]
