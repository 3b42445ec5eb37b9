"""Shared pieces: table reads, the shared folder, and vectorised word handling on Arrow buffers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes handled at once inside a task; bounds the working arrays of numpy code.
CHUNK_BYTES = 2_000_000

HASH_MULT = 0x9E3779B97F4A7C15  # odd, so invertible modulo 2**64
HASH_INV = pow(HASH_MULT, -1, 2**64)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``; a session in one process that has none gets a local one."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="halocline-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str | None = None, sort_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and every executor sees the rows."""
    spark = df.sparkSession
    path = path or shared_dir(spark)
    out = df.sortWithinPartitions(sort_by) if sort_by else df
    out.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of an operator in one folder under the shared one, which goes when its result needs them no more."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.path, self.tables = spark, shared_dir(spark), 0

    def write(self, df: DataFrame) -> DataFrame:
        self.tables += 1
        return materialize(df, f"{self.path}/{self.tables:04d}")

    def clear(self) -> None:
        remove(self.spark, self.path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store, wherever that is."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def committed(spark: SparkSession, path: str) -> list[str]:
    """Names of the tables in a folder that were written to their end, in order."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/*/_SUCCESS")
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return sorted(f.getPath().getParent().getName() for f in found or [])


def one_row(df: DataFrame, keys: list[str], row: str, counted: DataFrame | None = None) -> DataFrame:
    """``df`` with one row of each key (no nulls): of repeated keys the struct ``row`` of the least hash stays.

    Only repeated keys are aggregated by their rows, in each task first; ``counted`` has the keys of the rows of ``df``
    where that is cheaper to read.
    """
    repeated = materialize((df if counted is None else counted).groupBy(*keys).agg(F.count("*").alias("n_rows_")).where("n_rows_ > 1").select(*keys))
    if repeated.isEmpty():
        return df.select(*keys, row)
    again = df.join(repeated.hint("merge"), keys, "left_semi").groupBy(*keys).agg(F.min_by(row, F.xxhash64(row)).alias(row))
    return df.join(repeated.hint("merge"), keys, "left_anti").select(*keys, row).unionByName(again)


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def in_train_folds(doc_id: str = "doc_id") -> Column:
    """Rows that may teach: crc32 of the id as text, modulo 4, is not 2."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) != 2


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only, on the JVM."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- Arrow helpers (run inside tasks)


def small_batches(batches: Iterator[pa.RecordBatch], text_index: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose text is about ``limit`` bytes at most (one row may exceed it)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = text_buffers(batch.column(text_index))[0]
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column without copying; a null row has no bytes of its own."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return offsets.astype(np.int64), np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def local_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """As text_buffers, with offsets from 0 and only this column's bytes."""
    offsets, data = text_buffers(column)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` once A-Z is lower-cased: digits, a-z and all of UTF-8's high bytes.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[48:58] = WORD_BYTE[97:123] = WORD_BYTE[128:] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word in lower-cased bytes; words do not cross rows."""
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    inside = WORD_BYTE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


_POWERS: dict[str, np.ndarray] = {}


def powers(base: int, n: int, key: str) -> np.ndarray:
    """base**i modulo 2**64 for i in 0..n-1, kept for the next call."""
    have = _POWERS.get(key)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= 4 * CHUNK_BYTES:  # a single enormous text does not stay in memory
            _POWERS[key] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits depend on all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes; equal words have equal hashes wherever they stand."""
    if not len(start):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(HASH_MULT, len(data), "p"), out=total[1:])
    return mix((total[end] - total[start]) * powers(HASH_INV, len(data), "i")[start])
