"""SimHash near-duplicates with BK-trees.

Fingerprints: each bit is the majority of that bit over the XXH64 hashes of a text's word shingles.  Two
fingerprints link when at most ``radius`` bits differ, and documents of linked fingerprints form components.

Links between distinct fingerprints are searched by pigeonhole: of four 16-bit blocks, two fingerprints with at
most two differing bits share two whole blocks.  So the six block pairs, each with its place, are shard keys; a
shard holds the fingerprints that agree on 32 bits.  Shards above SHARD_LIMIT are split again in the same way on
their other 32 bits, after which a shard agrees on 48 bits and so holds 2**16 fingerprints at most.  A task
builds a BK-tree per shard (children keyed by their Hamming distance to the parent), follows only the edges
within the radius, and returns a spanning forest of the links it finds: no more edges than fingerprints.
Components come from hash-to-min rounds over those edges, each written to the shared folder.

Edge cases: null, empty and blank texts have fingerprint zero and link like any other; fewer words than a
shingle give one shingle of all; repeated rows give a row each; null ids link, but never name a component
unless all its ids are null; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halocline.llm.common import materialize, read_table, shared_dir, small_batches

SHINGLE = 3
SEED = 42
RADIUS = 2
#: Fingerprints in a shard before it is split on the bits that its members need not share.
SHARD_LIMIT = 2_000
#: The block pairs of a 32-bit half are of 8-bit blocks, those of the whole of 16-bit blocks.
PAIRS = [(a, b) for a in range(4) for b in range(a + 1, 4)]


def shingle_hashes(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of each word shingle of a text, repeats included; of fewer words, that of the whole sequence."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    stops = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) + np.arange(len(words))).tolist()
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(s + 1 for s in stops[: n - 1])]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], seed) for a, b in zip(starts, stops[min(shingle, len(words)) - 1 :], strict=True)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):  # bounds the unpacked bits of a very long text
        ones += np.unpackbits(hashes[k : k + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of one text, unsigned."""
    return majority(shingle_hashes(text, shingle, seed))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): a row per document, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            fps = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


# ---------------------------------------------------------------- BK-trees


class BKTree:
    """Distinct fingerprints; a node's children are keyed by their distance to it."""

    def __init__(self, fps: np.ndarray) -> None:
        self.fps = fps
        self.children: list[dict[int, int]] = [{} for _ in fps]
        stack = [np.arange(len(fps))] if len(fps) else []
        while stack:  # the first of each list is the node, the others hang below it by distance
            node, rest = stack[-1][0], stack.pop()[1:]
            if len(rest):
                apart = np.bitwise_count(fps[rest] ^ fps[node])
                for d in np.unique(apart).tolist():
                    below = rest[apart == d]
                    self.children[node][d] = int(below[0])
                    stack.append(below)

    def within(self, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each node, the places of the fingerprints within the radius of it (itself left out)."""
        stack = [(0, np.arange(len(self.fps)))] if len(self.fps) else []
        while stack:
            node, asking = stack.pop()
            apart = np.bitwise_count(self.fps[asking] ^ self.fps[node]).astype(np.int64)
            near = asking[(apart <= radius) & (apart > 0)]
            if len(near):
                yield node, near
            for d, child in self.children[node].items():
                follow = asking[np.abs(apart - d) <= radius]
                if len(follow):
                    stack.append((child, follow))


def forest(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b) that join exactly the fingerprints which links join, one fewer than a component has members."""
    up = np.arange(len(fps))

    def roots(at: np.ndarray) -> np.ndarray:
        top = up[at]
        while len(np.flatnonzero(up[top] != top)):
            top = up[top]
        up[at] = top
        return np.unique(top)

    for node, near in BKTree(fps).within(radius):
        tops = roots(np.append(near, node))
        up[tops] = tops[0]
    tops = np.arange(len(fps))
    while (up[tops] != tops).any():
        tops = up[tops]
    moved = tops != np.arange(len(fps))
    return fps[moved], fps[tops[moved]]


def tree_links(shards: DataFrame, radius: int) -> DataFrame:
    """(a, b) links of a spanning forest within each shard; shards come as rows (kind, key, fp)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 3), np.int64)
        for batch in chain_none(batches):
            if batch is not None:
                held = np.concatenate((held, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)))
            if not len(held):
                continue
            cuts = np.flatnonzero((held[1:, :2] != held[:-1, :2]).any(axis=1)) + 1
            groups = np.split(held, cuts)
            held = groups.pop() if batch is not None else held[:0]
            found = [forest(np.ascontiguousarray(g[:, 2]).view(np.uint64), radius) for g in groups if len(g) > 1]
            a = np.concatenate([x[0] for x in found]) if found else np.zeros(0, np.uint64)
            b = np.concatenate([x[1] for x in found]) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return shards.repartition("kind", "key").sortWithinPartitions("kind", "key").select("kind", "key", "fp").mapInArrow(run, "a long, b long")


def chain_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def block(col, i: int, bits: int):
    return F.shiftrightunsigned(col, i * bits).bitwiseAND((1 << bits) - 1)


def keyed(fps: DataFrame, kinds: list) -> DataFrame:
    return fps.withColumn("shard", F.explode(F.array(*[F.struct(k.cast("long").alias("kind"), v.cast("long").alias("key")) for k, v in kinds]))).select("shard.kind", "shard.key", "fp")


def crowded(shards: DataFrame, write=materialize) -> DataFrame:
    """Shards of more than one fingerprint, with their size; a hot shard is one row per task before the shuffle.

    The sizes are written first, so that Spark may split a hot shard's rows in the join.
    """
    sizes = write(shards.groupBy("kind", "key").agg(F.count("*").alias("size")).where("size > 1"))
    return shards.join(sizes.hint("merge"), ["kind", "key"])


def links(fps: DataFrame, radius: int = RADIUS, shard_limit: int = SHARD_LIMIT, write=materialize) -> DataFrame:
    """Spanning links between distinct fingerprints (column ``fp``) of which at most ``radius`` (up to 2) bits differ."""
    assert 0 < radius <= 2, "four blocks of which two are shared find two differing bits at most"
    fp = F.col("fp")
    first = write(crowded(keyed(fps, [(F.lit(k), F.shiftleft(block(fp, a, 16), 16).bitwiseOR(block(fp, b, 16))) for k, (a, b) in enumerate(PAIRS)]), write))
    small = tree_links(first.where(F.col("size") <= shard_limit), radius)
    # the other two blocks of a shard of kind k, as one 32-bit number
    others = [tuple(x for x in range(4) if x not in p) for p in PAIRS]
    rest = F.element_at(F.array(*[F.shiftleft(block(fp, c, 16), 16).bitwiseOR(block(fp, d, 16)) for c, d in others]), (F.col("kind") + 1).cast("int"))
    large = first.where(F.col("size") > shard_limit).withColumn("rest", rest)
    if large.isEmpty():
        return small
    finer = [(F.col("kind") * 6 + k + 6, F.shiftleft(F.col("key"), 16).bitwiseOR(F.shiftleft(block(F.col("rest"), a, 8), 8).bitwiseOR(block(F.col("rest"), b, 8)))) for k, (a, b) in enumerate(PAIRS)]
    return small.unionByName(tree_links(crowded(keyed(large, finer), write).drop("size"), radius))


# ---------------------------------------------------------------- components


def components(edges: DataFrame, write=materialize) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the least node of its component.

    Each round points every node, and the roots it has met, at the least node seen next to them, until nothing
    moves.  Rows are aggregated before each shuffle, and both sides of each join are written to the shared folder
    first, so that Spark may split the rows of a node with very many neighbours.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = write(pairs)
    while True:
        # large star: larger neighbours point at the least of the node and its neighbours
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = write(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")))
        large = write(both.where("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        # small star: the node and its smaller neighbours point at the least of them
        low = write(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(low.hint("merge"), "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()
        after = write(small)
        done = after.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").isEmpty() and after.select(F.col("b").alias("a")).join(after, "a", "left_semi").isEmpty()
        pairs = after
        if done:
            roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """(doc_id, fp, component_id): a row per document."""
    spark = docs.sparkSession
    marked = materialize(fingerprints(docs), shared_dir(spark))
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(distinct.select("fp"), radius, shard_limit))
    named = materialize(distinct.join(roots.hint("merge"), distinct["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "first_id"))
    ids = materialize(named.groupBy("root").agg(F.min("first_id").alias("component_id")))
    table = materialize(named.join(ids.hint("merge"), "root").select("fp", "component_id"))
    return marked.join(table.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, that with the smallest id; all columns kept.

    Rows that share that smallest id share its fate; a component without any id keeps all its rows.
    """
    found = near_duplicates(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(found.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
