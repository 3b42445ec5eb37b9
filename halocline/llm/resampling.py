"""Importance resampling towards a target distribution, over hashed word and word-pair features.

Every task builds tries of the words of its own partition: a node below the root is a word, a node below that the pair
with the word that follows.  A node holds how often its path occurs and the CRC-32 state of the path's bytes, which a
child goes on from; counts are added up by bucket (state modulo BUCKETS), a row per bucket and task, and the totals of
corpus and target merge in one aggregation.  Their log-ratios, the gains, are BUCKETS numbers, which go to all tasks.
There the tries are built again with a gain at every node, and a document's weight is the mean over the paths it walks.
A trie covers CHUNK_BYTES of text (one longer text has its own), so memory does not grow with a partition.

The draw adds Gumbel noise derived from the id and takes the highest scores; ranks come from rows dealt by range of
score, numbered inside each task and moved by the rows of the tasks before.

Words are runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case; all arithmetic on counts is
exact.  Edge cases: a null or empty text has no features and weight 0; a null id counts as an empty one in the noise
and sorts first among ties; repeated rows are scored and drawn each by itself; further columns are ignored; an empty
corpus gives no rows; an empty target gives every bucket the smoothing alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from halocline.llm.common import LOWER, local_text, materialize, read_table, small_batches, word_spans

BUCKETS = 10_000
#: Documents of fewer words are scored but never drawn; this many percent of the others are.
LEAST_WORDS = 20
DRAW_PERCENT = 25
SEED = 7


# ---------------------------------------------------------------- tries (inside tasks)

CRC_TABLE = np.zeros(256, np.uint32)
for _byte in range(256):
    _c = _byte
    for _ in range(8):
        _c = (_c >> 1) ^ (0xEDB88320 if _c & 1 else 0)  # fixed value: CRC-32's polynomial, reflected
    CRC_TABLE[_byte] = _c


class Advance:
    """CRC states moved over as many bytes as a string has: crc(a + b) = moved(crc(a), len(b)) ^ crc(b)."""

    def __init__(self) -> None:
        self.tables = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])]

    def table(self, length: int) -> np.ndarray:
        while len(self.tables) <= length:  # one zero byte more, for each byte of the state by itself
            t = self.tables[-1]
            self.tables.append((t >> np.uint32(8)) ^ CRC_TABLE[t & np.uint32(255)])
        return self.tables[length]

    def __call__(self, states: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = np.zeros(len(states), np.uint32)
        for n in np.unique(lengths):
            rows = np.flatnonzero(lengths == n) if len(lengths) else np.zeros(0, np.int64)
            s, t = states[rows], self.table(int(n))
            out[rows] = t[0, s & 255] ^ t[1, (s >> 8) & 255] ^ t[2, (s >> 16) & 255] ^ t[3, s >> 24]
        return out


class Trie:
    """Words and word pairs of some texts: states and counts of the nodes, and each text's paths through them."""

    #: Strings over this length are hashed on from their parent's state byte by byte.
    TABLED = 64

    def __init__(self, column: pa.Array, advance: Advance) -> None:
        offsets, data = local_text(column)
        data = LOWER[data]
        start, end, self.row = word_spans(data, offsets)
        self.texts = len(column)
        lens = end - start
        # the words' bytes one after the other, numbered by Arrow's exact dictionary
        inside = np.zeros(len(data) + 1, np.int8)
        inside[start] += 1
        inside[end] -= 1
        flat = data[np.cumsum(inside[:-1]) > 0]
        stops = np.concatenate(([0], np.cumsum(lens)))
        found = pa.Array.from_buffers(pa.large_binary(), len(lens), [None, pa.py_buffer(stops.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat))]).dictionary_encode()
        words = found.dictionary.to_pylist()
        self.word = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.word_state = np.array([zlib.crc32(w) for w in words], np.uint32)
        self.word_count = np.bincount(self.word, minlength=len(words))
        # below each word, the words that follow it in a text
        self.follows = np.flatnonzero(self.row[1:] == self.row[:-1])
        pairs, self.pair, self.pair_count = np.unique(self.word[self.follows] * max(len(words), 1) + self.word[self.follows + 1], return_inverse=True, return_counts=True)
        parent, child = pairs // max(len(words), 1), pairs % max(len(words), 1)
        step = np.array([zlib.crc32(b" " + w) for w in words], np.uint32)
        length = np.array([len(w) + 1 for w in words], np.int64)
        far = length[child] > self.TABLED
        self.pair_state = np.zeros(len(pairs), np.uint32)
        near = np.flatnonzero(~far)
        self.pair_state[near] = advance(self.word_state[parent[near]], length[child[near]]) ^ step[child[near]]
        for k in np.flatnonzero(far):
            self.pair_state[k] = zlib.crc32(b" " + words[child[k]], int(self.word_state[parent[k]]))

    def add_to(self, totals: np.ndarray) -> None:
        """Counts of the nodes by bucket."""
        for state, count in ((self.word_state, self.word_count), (self.pair_state, self.pair_count)):
            np.add.at(totals, state.astype(np.int64) % len(totals), count)

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(words, features) of each text."""
        n = np.bincount(self.row, minlength=self.texts)
        return n, n + np.bincount(self.row[self.follows], minlength=self.texts)

    def gained(self, gains: np.ndarray) -> np.ndarray:
        """The sum of gains along each text's paths, in whole numbers."""
        total = np.zeros(self.texts, np.int64)
        np.add.at(total, self.row, gains[self.word_state.astype(np.int64) % len(gains)][self.word])
        np.add.at(total, self.row[self.follows], gains[self.pair_state.astype(np.int64) % len(gains)][self.pair])
        return total


# ---------------------------------------------------------------- the operator


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all features of all texts; tasks add up their tries first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, advance = np.zeros(buckets, np.int64), Advance()
        for batch in small_batches(batches, 0):
            Trie(batch.column(0), advance).add_to(totals)
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])], ["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain): 1000 times the log-ratio of smoothed shares, floored, of every bucket."""
    every = corpus.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    counted = every.join(bucket_counts(corpus, buckets).withColumnRenamed("n", "s"), "bucket", "left").join(bucket_counts(target, buckets).withColumnRenamed("n", "t"), "bucket", "left")
    counted = materialize(counted.fillna(0, ["s", "t"]))
    all_s, all_t = (F.lit(float(x)) for x in counted.agg(F.sum("s"), F.sum("t")).first())
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    return counted.select("bucket", F.floor(1000 * F.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets)))).alias("gain"))


def weighted(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight), a row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        advance = Advance()
        for batch in small_batches(batches, 1):
            trie = Trie(batch.column(1), advance)
            words, features = trie.features()
            weight = trie.gained(gains) // np.maximum(features, 1)  # numpy's // floors
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words), pa.array(features), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: str = "doc_id", seed: int = SEED) -> Column:
    """1000 times a standard Gumbel number that the id and the seed fix, floored."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with each row's place (1, 2, ...) in the whole order, without bringing all rows to one task.

    Rows are dealt by range and sorted, numbered in their task and moved by the rows of the tasks before; the table of
    tasks has a row for each.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(done + 1, done + n + 1))], [*batch.schema.names, "part_", "place_"])
            done += n

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + ["part_ int", "place_ long"])
    dealt = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(place, schema))
    sizes = dealt.groupBy("part_").agg(F.count("*").alias("n_"))
    before = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    moved = sizes.select("part_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("before_"))
    return dealt.join(F.broadcast(moved), "part_").withColumn(name, F.col("place_") + F.col("before_")).drop("part_", "place_", "before_")


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, percent: int = DRAW_PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank): every document, with its rank if it is drawn."""
    gains = np.zeros(buckets, np.int64)
    for bucket, gain in bucket_gains(docs, target, buckets).collect():  # as many rows as buckets
        gains[bucket] = gain
    scored = materialize(weighted(docs, gains).withColumn("score", F.col("weight") + gumbel(seed=seed)))
    long_enough = F.col("n_words") >= least_words
    drawn = scored.where(long_enough).count() * percent // 100
    ranked = numbered(scored.where(long_enough), [F.col("score").desc(), F.col("doc_id").asc_nulls_first()], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(scored.where(~long_enough).withColumn("rank", F.lit(None).cast("long")))


def draw(docs: DataFrame, target: DataFrame, **settings: int) -> DataFrame:
    """The drawn documents, all columns; rows of a drawn id are told apart by nothing else, so ids should be distinct."""
    chosen = resample(docs, target, **settings).where("rank IS NOT NULL").select("doc_id").distinct()
    return docs.join(chosen, "doc_id", "left_semi")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank", "n_words")
