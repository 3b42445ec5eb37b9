"""Spark and DuckDB side by side on the same tables."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if type(v).__name__ == "Decimal":
        return float(v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "tzinfo") and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def compare(spark, con, sf_dir, query, sql):
    """None if both give the same rows, else what differs."""
    df = query(spark, sf_dir)
    mine = rows(df.columns, df.collect())
    rel = con.sql(sql)
    theirs = rows(rel.columns, rel.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} and {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} and {len(theirs[1])} rows"
    bad = [(a, b) for a, b in zip(mine[1], theirs[1], strict=True) if a != b]
    kinds = [(c, type(x).__name__, type(y).__name__) for c, x, y in zip(mine[0], *(m[1][0] for m in (mine, theirs)), strict=True) if x is not None and y is not None and type(x) is not type(y)] if mine[1] else []
    return f"{len(bad)} rows differ: {bad[:3]}" if bad else f"types differ: {kinds}" if kinds else None
