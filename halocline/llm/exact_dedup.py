"""Exact dedup over a log-structured merge index of text digests.

An index is a folder of runs and nothing else, so it can be opened again later.  Flushing documents puts the digests of
each task's rows into a memtable, which holds at most MEMTABLE_ROWS digests; a full memtable is emitted sorted by digest,
with the best identifier and the number of rows of each digest.  A run's name tells which flushes it covers.  Compaction
is tiered: FANOUT runs of one size class are merged into a run of the next, keeping one identifier per digest, and the
merged runs go once the new one is written to its end.  Each run has a filter of fixed size over its digests, made at its
flush, and a lookup of new digests joins a run only with those that its filter and its range of digests let through.

Documents come in parts.  Each part is flushed, and its digests are looked up in the runs before it; runs are
compacted by tiers as they come.  A digest that comes again, in its part or in an earlier run, is a hit; the index is
asked for the hits' identifiers and numbers at the end, and rows of other digests stand alone without being joined with
it.  The texts of hits are verified byte by byte, by grouping on the text
itself.  A filter over the hit digests, of fixed size, keeps other texts out of that shuffle.  Digests are never
trusted: where one digest has several texts, its rows are told apart by their text.

``keep`` is "max" or "min": the largest or the smallest doc_id of equal texts stays.

Edge cases: a null text equals an empty one; repeated rows of one doc_id count as rows, each is kept when its
id is the kept one; a null doc_id is kept only when all ids of its group are null (keep_id is then null);
further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from halocline.llm.common import committed, materialize, one_row, read_table, remove, shared_dir, text_or_empty

#: Digests held by a task before it flushes a sorted run.
MEMTABLE_ROWS = 500_000
#: Bits of the filter over hit digests: a fixed 1 MB; a full filter lets more texts through, never fewer.
FILTER_BITS = 1 << 23
#: Bits of a run's filter: 128 kB, as a lookup sends one for each run; what a full one lets through meets the run in a join.
RUN_FILTER_BITS = 1 << 20

#: Runs of one size class that are merged into one of the next.
FANOUT = 4
#: Parts in which a table of documents is flushed, by their ids' hash: FANOUT of them are compacted, and one more is looked up
#: in the run that came of it.  Each takes some more small jobs, whose plans stay in the driver's memory for a while; a stage
#: within a longer program takes its documents in one.
FLUSHES = FANOUT + 1

RUN_SCHEMA = "digest binary, best long, n long"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


Span = tuple[int, int, int]


class DigestIndex:
    """Runs of digests under one folder, named by the flushes that they cover and the merges behind them: ``00000-00003-1``."""

    def __init__(self, spark: SparkSession, path: str, keep: str = "max", memtable_rows: int = MEMTABLE_ROWS, filter_bits: int = RUN_FILTER_BITS) -> None:
        assert keep in ("max", "min")
        self.spark, self.path, self.keep, self.memtable_rows, self.filter_bits = spark, path, keep, memtable_rows, filter_bits

    def spans(self) -> list[Span]:
        """(first, last, merges) of each run; a run that a later merge covers is none any more."""
        every = [tuple(map(int, name.split("-"))) for name in committed(self.spark, f"{self.path}/runs")]
        return [r for r in every if not any(o[2] > r[2] and o[0] <= r[0] and r[1] <= o[1] for o in every)]

    def name(self, span: Span, kind: str = "runs") -> str:
        return f"{self.path}/{kind}/{span[0]:05d}-{span[1]:05d}-{span[2]}"

    @property
    def runs(self) -> list[str]:
        return [self.name(s) for s in self.spans()]

    def flush(self, digests: DataFrame) -> Span:
        """Add rows (doc_id, digest) as a new run with its filter; one that died before its end is done again in its place."""
        keep, limit = self.keep, self.memtable_rows

        def memtable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, rows = [], 0
            for batch in batches:
                held.append(pa.table([batch.column(1), batch.column(0), pa.array([1] * batch.num_rows, pa.int64())], ["digest", "best", "n"]))
                rows += batch.num_rows
                if rows >= limit:  # merge once at the limit; what stays below half of it is filled up again
                    held = [merged(pa.concat_tables(held), keep)]
                    rows = held[0].num_rows
                    if rows > limit // 2:
                        yield from sorted_run(held[0])
                        held, rows = [], 0
            if held:
                yield from sorted_run(merged(pa.concat_tables(held), keep))

        after = max([last for _, last, _ in self.spans()], default=-1) + 1
        span = (after, after, 0)
        self.write(digests.select("doc_id", "digest").mapInArrow(memtable, RUN_SCHEMA), span)
        remove(self.spark, self.name(span, "filters"))  # of a run that died
        self.filter_of(span)
        return span

    def ingest(self, digests: DataFrame, flushes: int = FLUSHES) -> DataFrame:
        """Flush rows (doc_id, digest) in parts; the digests that come again, in their part or in a run before it."""
        hits = []
        for k in range(flushes):
            before = self.spans()
            span = self.flush(digests.where(F.pmod(F.xxhash64("doc_id"), F.lit(flushes)) == k))
            new = materialize(self.read([span]).groupBy("digest").agg(F.sum("n").alias("n")))
            hits.append(new.where("n > 1").select("digest"))
            if before:
                hits.append(materialize(self.lookup(new, before).select("digest")))
            while self.compact_tier():
                pass
        return materialize(reduce(DataFrame.unionByName, hits).distinct())

    def write(self, run: DataFrame, span: Span) -> None:
        run.write.mode("overwrite").parquet(self.name(span))

    def read(self, spans: list[Span] | None = None) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.spark.read.schema(RUN_SCHEMA).parquet(self.name(s)) for s in spans or self.spans()])

    def merge(self, spans: list[Span]) -> None:
        """Replace neighbouring runs by one, sorted by digest in each of its files."""
        best = F.max("best") if self.keep == "max" else F.min("best")
        whole = (spans[0][0], spans[-1][1], max(s[2] for s in spans) + 1)
        self.write(self.read(spans).groupBy("digest").agg(best.alias("best"), F.sum("n").alias("n")).sortWithinPartitions("digest"), whole)
        for s in spans:
            remove(self.spark, self.name(s))
            remove(self.spark, self.name(s, "filters"))

    def compact(self) -> DataFrame:
        """Merge all runs into one."""
        self.merge(self.spans())
        return self.read()

    def compact_tier(self) -> bool:
        """Merge the last FANOUT runs of one size class, if there are so many; the class is the logarithm of the flushes."""
        spans = self.spans()
        size = [0] * len(spans)
        for k, (first, last, _) in enumerate(spans):
            while FANOUT ** (size[k] + 1) <= last - first + 1:
                size[k] += 1
        for k in range(len(spans) - FANOUT, -1, -1):
            if len(set(size[k : k + FANOUT])) == 1:
                self.merge(spans[k : k + FANOUT])
                return True
        return False

    def filter_of(self, span: Span) -> DataFrame:
        """One row: a run's filter and its range of digests; made now if the run was written but its filter was not."""
        at = self.name(span, "filters")
        if at.rsplit("/", 1)[1] not in committed(self.spark, f"{self.path}/filters"):
            run = self.read([span])
            ends = run.agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
            materialize(ends.withColumn("words", hit_filter(self.spark, run, self.filter_bits)), at)
        return self.spark.read.parquet(at)

    def lookup(self, digests: DataFrame, spans: list[Span] | None = None) -> DataFrame:
        """(digest, best, n) of those of ``digests`` (column digest, distinct) that the index has, over all or some runs."""
        found = []
        for span in self.spans() if spans is None else spans:
            own = self.filter_of(span)
            low, high, words = (own.select(c).scalar() for c in ("low", "high", "words"))
            asked = digests.select("digest").where(F.col("digest").between(low, high) & passes(words, self.filter_bits))
            found.append(self.read([span]).join(asked, "digest", "left_semi"))
        best = F.max("best") if self.keep == "max" else F.min("best")
        rows = reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame([], RUN_SCHEMA)
        return rows.groupBy("digest").agg(best.alias("best"), F.sum("n").alias("n"))


def merged(table: pa.Table, keep: str) -> pa.Table:
    out = table.group_by("digest").aggregate([("best", keep), ("n", "sum")])
    return out.rename_columns({f"best_{keep}": "best", "n_sum": "n"}).select(["digest", "best", "n"])


def sorted_run(table: pa.Table) -> Iterator[pa.RecordBatch]:
    yield from table.take(pc.sort_indices(table, [("digest", "ascending")])).combine_chunks().to_batches(max_chunksize=50_000)


def hit_filter(spark: SparkSession, hits: DataFrame, bits: int) -> Column:
    """A scalar: the words of a bitmap with one bit for each hit digest's hash."""
    place = F.pmod(F.xxhash64("digest"), F.lit(bits))
    words = hits.select(place.alias("p")).groupBy((F.col("p") / 64).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("v"))
    # a map would be searched from its start, so the words lie in one string of 16 hex digits each
    every = spark.range(bits // 64).select(F.col("id").cast("int").alias("w"), F.lit(0).cast("long").alias("v"))
    filled = words.unionByName(every).groupBy("w").agg(F.bit_or("v").alias("v"))
    packed = filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "v"))), lambda x: x["v"]).alias("words"))
    return materialize(packed).scalar()


def passes(words: Column, bits: int) -> Column:
    place = F.pmod(F.xxhash64("digest"), F.lit(bits))
    word = F.element_at(words, F.floor(place / 64).cast("int") + 1)
    return F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1


def exact_groups(docs: DataFrame, keep: str = "max", digest=sha256, path: str | None = None, filter_bits: int = FILTER_BITS, flushes: int = FLUSHES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest): a row for every row of ``docs``."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn("digest", digest(F.col("text")))
    digests = materialize(texts.select("doc_id", "digest"))
    index = DigestIndex(spark, path or shared_dir(spark), keep)
    hits = index.ingest(digests, flushes)
    found = materialize(index.lookup(hits))
    words = hit_filter(spark, hits, filter_bits)
    best = F.max("doc_id") if keep == "max" else F.min("doc_id")
    # byte verification: rows of one digest are equal only when they fall into one group by their text
    verified = texts.where(passes(words, filter_bits)).groupBy("digest", "text").agg(best.alias("best"), F.count("*").alias("n"))
    clashing = materialize(verified.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1").select("digest"))

    def rows(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        joined = left.join(right.hint("merge"), on, "left")  # a row without a hit is the only one of its text
        keep_id = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("best"))
        return joined.select("doc_id", keep_id.alias("keep_id"), F.coalesce("n", F.lit(1).cast("long")).alias("group_size"), F.col("doc_id").eqNullSafe(keep_id).alias("kept"), "digest")

    if clashing.isEmpty():
        return rows(digests, found, ["digest"])
    apart = rows(digests.join(clashing, "digest", "left_anti"), found, ["digest"])
    clashing_texts = texts.join(clashing, "digest", "left_semi")
    return apart.unionByName(rows(clashing_texts, clashing_texts.groupBy("digest", "text").agg(best.alias("best"), F.count("*").alias("n")), ["digest", "text"]))


def keep_one(docs: DataFrame, keep: str = "max") -> DataFrame:
    """The row with the kept id of every group of equal texts; all columns kept.

    Rows that share a doc_id are judged by their own texts; rows without an id always stay.
    """
    dropped = exact_groups(docs, keep).where("not kept and doc_id is not null").select("doc_id", "digest")
    same = (docs["doc_id"] == dropped["doc_id"]) & (sha256(text_or_empty()) == dropped["digest"])
    return docs.join(dropped.hint("merge"), same, "left_anti").select(*docs.columns)


def one_each(docs: DataFrame, keep: str = "max") -> DataFrame:
    """One row of every group of equal texts, all columns kept: of the rows with the kept id, that of the least hash.

    A null id loses to any other; a group without any id keeps one row.
    """
    found = exact_groups(docs, keep, flushes=1)
    dropped = materialize(found.where("not kept").select(F.col("doc_id").alias("id_"), F.col("digest").alias("digest_")))
    rows = docs.select(F.col("doc_id").cast("long").alias("id_"), sha256(text_or_empty()).alias("digest_"), F.struct(*docs.columns).alias("row_"))
    same = rows["id_"].eqNullSafe(dropped["id_"]) & (rows["digest_"] == dropped["digest_"])
    kept = rows.join(dropped.hint("merge"), same, "left_anti")
    return one_row(kept, ["digest_"], "row_", found.where("kept").select(F.col("digest").alias("digest_"))).select("row_.*")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_groups(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE_SQL = {
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))"""
}
