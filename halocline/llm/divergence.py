"""Source divergence audit: how far apart the sources of a language are, and which terms set a source apart.

Every language keeps the terms of at least LEAST_DOCS of its documents, numbered in order of their bytes and cut into
blocks of BLOCK terms.  A group (language, source) is a vector of counts per block, held as the differences of its
term numbers and its counts, deflated.  Smoothed shares of the kept terms are whole billionths.

Systolic rotation.  The groups of a language sit in seats; seats meet in the rounds of a round-robin tournament, so
that each two meet once.  A seat's own vectors stay in its partition while those of the other seat of the round stream
by, one compressed vector at a time; each meeting is evaluated for both sides at once.  A block of terms is a tournament
of its own, so that a source with most of the terms is spread over tasks, and partial sums add up by pair.  Rounds run in
waves of ROUNDS_A_WAVE, which bounds what circulates at a time; a seat holds at most about SEAT_BYTES of vectors.
In its seat each group also meets its language's vector, and a local heap of each block keeps the TOP_TERMS best terms.

Edge cases: null text, lang or source is an empty one; a group without kept terms has the smoothing alone; a language
without kept terms gives pairs of value 0 and no terms, one source gives no pairs; equal values rank by the bytes of
their items; repeated rows count each; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from halocline.llm.common import LOWER, local_text, materialize, read_table, small_batches
from halocline.llm.resampling import numbered

LEAST_DOCS = 30
SMOOTH = 5
TOP_TERMS = 50
#: Terms of a block; vectors of a seat; seats that a language with enough groups has at least; rounds of one job.
BLOCK = 8192
SEAT_BYTES = 8_000_000
LEAST_SEATS = 8
ROUNDS_A_WAVE = 8
#: Text bytes that a task counts at once.
COUNT_BYTES = 8_000_000

#: Bytes of `[^\x00-\x40\x5B-\x60\x7B-\x7F]` once A-Z is lower-cased: a-z and all of UTF-8's high bytes.
TERM_BYTE = np.zeros(256, bool)
TERM_BYTE[97:123] = TERM_BYTE[128:] = True


# ---------------------------------------------------------------- counts


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2, COUNT_BYTES):
            offsets, data = local_text(batch.column(2))
            data = LOWER[data]
            inside = TERM_BYTE[data]
            first = inside.copy()
            first[1:] &= ~inside[:-1]
            cuts = offsets[1:-1]
            cuts = cuts[(cuts > 0) & (cuts < len(data))]
            first[cuts] = inside[cuts]  # terms do not cross rows
            start = np.flatnonzero(first)
            row = np.searchsorted(offsets, start, side="right") - 1
            # the terms' bytes one after the other: a term ends where the next begins
            flat = np.ascontiguousarray(data[inside])
            stops = np.append(np.cumsum(inside)[start] - 1, len(flat)) if len(start) else np.zeros(1, np.int64)
            found = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(stops.astype(np.int64)), pa.py_buffer(flat)]).dictionary_encode()
            term, names = found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary
            named = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            keys = {g: k for k, g in enumerate(dict.fromkeys(named))}
            group = np.array([keys[g] for g in named], np.int64)
            width = max(len(names), 1)
            in_doc, times = np.unique(row * width + term, return_counts=True)  # a document's terms
            key, which = np.unique(group[in_doc // width] * width + in_doc % width, return_inverse=True)
            n, own = np.zeros(len(key), np.int64), np.bincount(which, minlength=len(key))
            np.add.at(n, which, times)
            every = list(keys)
            langs, sources = pa.array([g[0] for g in every], pa.string()), pa.array([g[1] for g in every], pa.string())
            at = pa.array(key // width)
            yield pa.RecordBatch.from_arrays([langs.take(at), sources.take(at), names.take(pa.array(key % width)).cast(pa.string()), pa.array(n), pa.array(own.astype(np.int64))], ["lang", "source", "term", "n", "docs"])

    empty = F.lit("")
    texts = docs.select(*(F.coalesce(F.col(c), empty).alias(c) for c in ("lang", "source", "text")))
    return texts.mapInArrow(run, "lang string, source string, term string, n long, docs long").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: np.ndarray | int, total: int, v: int) -> np.ndarray:
    """1 + floor(10**9 * (count + SMOOTH) / (total + SMOOTH * v)), exact up to totals of 9e13."""
    below = total + SMOOTH * v
    a = np.asarray(count, np.int64) + SMOOTH
    whole, rest = a // below, a % below
    high, rest = rest * 100_000 // below, rest * 100_000 % below
    return 1 + whole * 1_000_000_000 + high * 10_000 + rest * 10_000 // below


# ---------------------------------------------------------------- vectors


def pack_vector(ids: np.ndarray, counts: np.ndarray) -> bytes:
    return zlib.compress(np.concatenate((np.diff(ids, prepend=0), counts)).astype("<i8").tobytes(), 1)


def unpack_vector(packed: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    if packed is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    flat = np.frombuffer(zlib.decompress(packed), "<i8")
    return np.cumsum(flat[: len(flat) // 2]), flat[len(flat) // 2 :]


def packed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A vector for each of ``keys`` (a block's terms at most) from rows with id and n."""
    lists = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("v"))
    schema = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys) + ", vector binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(len(keys))
            at, flat = np.array(v.offsets), v.values
            ids, n = (np.array(flat.field(k)) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array([pack_vector(ids[a:b], n[a:b]) for a, b in zip(at, at[1:], strict=False)], pa.binary())], [*keys, "vector"])

    return lists.select(*keys, "v").mapInArrow(run, schema)


def rounds_of(seats: int) -> int:
    """Rounds of a tournament in which all seats meet once."""
    return 0 if seats < 2 else seats - 1 + seats % 2


def host_of(seat: int, round_: int, seats: int) -> int | None:
    """The seat that ``seat`` calls on in a round (from 1), None if it stays in its place.

    Seats stand on a circle of odd size m: in round r those meet whose numbers add up to r modulo m.  With an even
    number the last one stands in the middle and meets the one that would have met itself.  The larger one calls.
    """
    m = seats - 1 + seats % 2
    if seat == m:  # the middle, only where the number is even
        peer = next(k for k in range(m) if 2 * k % m == round_ % m)
    else:
        peer = (round_ - seat) % m
        if peer == seat:
            peer = m if seats % 2 == 0 else seat
    return peer if peer < seat else None


#: One row per (language, block, group): its vector, its total, and what its language has.
GROUP = "lang string, block int, member long, seat int, seats int, source string, vector binary, total long, v long, v_block long"
MEETING = "host int, round int"
PAIR = "lang string, a long, b long, value long"
TERM = "lang string, member long, id long, value long"


def meetings(groups: DataFrame, first: int, last: int) -> DataFrame:
    """The vectors of rounds first..last at their hosts: residents are of round 0, then callers in order of rounds."""

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seat, seats = batch.schema.get_field_index("seat"), batch.schema.get_field_index("seats")
            rows, host, at = [], [], []
            for k, (s, n) in enumerate(zip(batch.column(seat).to_pylist(), batch.column(seats).to_pylist(), strict=True)):
                for r in range(first, min(last, rounds_of(n)) + 1):
                    h = s if r == 0 else host_of(s, r, n)
                    if h is not None:
                        rows.append(k)
                        host.append(h)
                        at.append(r)
                if first > 0 and first <= rounds_of(n):  # residents come again in each wave
                    rows.append(k)
                    host.append(s)
                    at.append(0)
            out = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(host, pa.int32()), pa.array(at, pa.int32())], [*out.schema.names, "host", "round"])

    sent = groups.mapInArrow(call, f"{GROUP}, {MEETING}")
    return sent.repartition("lang", "block", "host").sortWithinPartitions("lang", "block", "host", "round", "member")


class Shares:
    """A group's shares over one block's terms: those it has, and what all others have."""

    def __init__(self, row: dict) -> None:
        self.member = row["member"]
        self.ids, count = unpack_vector(row["vector"])
        self.p, self.rest = share(count, row["total"], row["v"]), int(share(0, row["total"], row["v"])) if row["v"] else 0

    def distance(self, other: Shares, v_block: int) -> int:
        both, mine, theirs = np.intersect1d(self.ids, other.ids, assume_unique=True, return_indices=True)
        total = int(np.abs(self.p[mine] - other.p[theirs]).sum())
        total += int(np.abs(self.p - other.rest).sum()) - int(np.abs(self.p[mine] - other.rest).sum())
        total += int(np.abs(other.p - self.rest).sum()) - int(np.abs(other.p[theirs] - self.rest).sum())
        return total + (v_block - len(self.ids) - len(other.ids) + len(both)) * abs(self.rest - other.rest)


def meet(at_hosts: DataFrame, with_residents: bool) -> DataFrame:
    """(lang, a, b, value) of a block for every two groups that meet, both ways; residents meet each other in round 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, residents = None, []
        for batch in batches:
            out = []
            for row in (r for k in range(0, batch.num_rows, 64) for r in batch.slice(k, 64).to_pylist()):
                if (place := (row["lang"], row["block"], row["host"])) != here:
                    here, residents = place, []
                one = Shares(row)
                if row["round"] > 0 or with_residents:
                    for other in residents:
                        value = one.distance(other, row["v_block"])
                        out += [(row["lang"], one.member, other.member, value), (row["lang"], other.member, one.member, value)]
                if row["round"] == 0:
                    residents.append(one)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["lang", "a", "b", "value"])

    return at_hosts.mapInArrow(run, PAIR)


def best_terms(groups: DataFrame, langs: DataFrame, top: int) -> DataFrame:
    """(lang, member, id, value): of each group and block, the terms that stand out most against the language in its seat."""
    rows = groups.where("vector IS NOT NULL").join(langs, ["lang", "block", "seat"]).select("lang", "member", "vector", "total", "v", "lang_vector", "lang_total")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in (r for k in range(0, batch.num_rows, 64) for r in batch.slice(k, 64).to_pylist()):
                ids, n = unpack_vector(r["vector"])
                of_lang, lang_n = unpack_vector(r["lang_vector"])
                over = share(n, r["total"], r["v"]) - share(lang_n[np.searchsorted(of_lang, ids)], r["lang_total"], r["v"])
                some = np.flatnonzero(over > 0)
                if len(some) > top:  # ties at the last place stay for the heap
                    some = some[over[some] >= np.partition(over[some], -top)[-top]]
                heap = heapq.nsmallest(top, zip((-over[some]).tolist(), ids[some].tolist(), strict=True))
                out += [(r["lang"], r["member"], i, -f) for f, i in heap]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["lang", "member", "id", "value"])

    return rows.mapInArrow(run, TERM)


# ---------------------------------------------------------------- the operator


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, block: int = BLOCK, seat_bytes: int = SEAT_BYTES, least_seats: int = LEAST_SEATS, wave: int = ROUNDS_A_WAVE) -> DataFrame:
    """(lang, source, part, item, value, rank): pairs of a language's sources, and each source's outstanding terms."""
    counts = materialize(term_counts(docs))
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= least_docs)
    order = numbered(kept.select("lang", "term", "lang_n"), [F.col("lang"), F.col("term")], "place")
    firsts = order.groupBy("lang").agg(F.min("place").alias("first"), F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    terms = materialize(order.join(firsts, "lang").select("lang", "term", "lang_n", (F.col("place") - F.col("first")).alias("id"), ((F.col("place") - F.col("first")) / block).cast("int").alias("block"), "v", "lang_total"))
    langs = packed(terms.select("lang", "block", "id", F.col("lang_n").alias("n")), ["lang", "block"]).withColumnRenamed("vector", "lang_vector")
    # every group that occurs, with its place in its language's circle, in each block
    empty = F.lit("")
    sources = docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source")).distinct()
    with_terms = counts.join(terms.select("lang", "term", "id", "block"), ["lang", "term"])
    vectors = materialize(packed(with_terms.select("lang", "source", "block", "id", "n"), ["lang", "source", "block"]).join(group_totals(with_terms), ["lang", "source"]))
    members = numbered(sources, [F.col("lang"), F.col("source")], "member")
    circle = members.join(members.groupBy("lang").agg(F.min("member").alias("first"), F.count("*").alias("n_groups")), "lang")
    sizes = vectors.groupBy("lang").agg(F.sum(F.length("vector")).alias("bytes"))
    of_lang = terms.groupBy("lang").agg(F.max("v").alias("v"), F.max("block").alias("last"), F.max("lang_total").alias("lang_total"))
    seats = F.least(F.col("n_groups"), F.greatest(F.lit(least_seats), F.ceil(F.coalesce("bytes", F.lit(0)) / (seat_bytes * (F.coalesce("last", F.lit(0)) + 1))))).cast("int")
    placed = circle.join(sizes, "lang", "left").join(of_lang, "lang", "left").withColumn("seats", seats)
    placed = placed.withColumn("seat", ((F.col("member") - F.col("first")) % F.col("seats")).cast("int")).withColumn("v", F.coalesce("v", F.lit(0)))
    blocks = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce("last", F.lit(0)))))
    totals = vectors.select("lang", "source", F.col("total").alias("total_")).distinct()
    v_block = F.least(F.lit(block), F.col("v") - F.col("block") * block).cast("long")
    groups = blocks.join(vectors.select("lang", "source", "block", "vector"), ["lang", "source", "block"], "left").join(totals, ["lang", "source"], "left")
    groups = materialize(groups.select("lang", "block", "member", "seat", "seats", "source", "vector", F.coalesce("total_", F.lit(0)).alias("total"), "v", v_block.alias("v_block"), "lang_total"))

    most = rounds_of(groups.agg(F.max("seats")).first()[0] or 0)
    residents = groups.drop("lang_total")
    parts = [meet(meetings(residents, 0, min(wave, most)), True)]
    for first in range(wave + 1, most + 1, wave):
        parts.append(meet(meetings(residents, first, min(first + wave - 1, most)), False))
    sums = [materialize(p.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))) for p in parts]  # a job for each wave
    pairs = sums[0]
    for more in sums[1:]:
        pairs = pairs.unionByName(more)
    names = members.select("lang", F.col("member").alias("b"), F.col("source").alias("item"))
    owners = members.select("lang", "member", "source")
    found = pairs.join(names, ["lang", "b"]).withColumnRenamed("a", "member").select("lang", "member", F.lit("pair").alias("part"), "item", "value")

    against = langs.join(placed.select("lang", "seats", "lang_total").distinct(), "lang").withColumn("seat", F.explode(F.sequence(F.lit(0), F.col("seats") - 1))).drop("seats")
    best = best_terms(groups.drop("lang_total"), against, top).join(terms.select("lang", "id", F.col("term").alias("item")), ["lang", "id"])
    found = found.unionByName(best.select("lang", "member", F.lit("term").alias("part"), "item", "value"))
    rank = F.row_number().over(Window.partitionBy("lang", "member", "part").orderBy(F.col("value").desc(), "item"))
    ranked = found.withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= top))
    return ranked.join(owners, ["lang", "member"]).select("lang", "source", "part", "item", "value", "rank")


def group_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(read_table(spark, sf_dir, "documents"))


ORACLE_SQL = {
    "op13_divergence": r"""
WITH docs AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (SELECT k, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT k) >= 30),
of_lang AS (SELECT lang, count(*) AS v, CAST(sum(n) AS BIGINT) AS total FROM kept GROUP BY lang),
sources AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, CAST(coalesce(sum(n), 0) AS BIGINT) AS total FROM sources LEFT JOIN counts USING (lang, source) GROUP BY ALL),
shares AS (
    SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
           CAST(1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (t.total + 5 * l.v) AS BIGINT) AS p,
           CAST(1 + 1000000000::HUGEINT * (k.n + 5) // (l.total + 5 * l.v) AS BIGINT) AS q
    FROM sources s JOIN kept k USING (lang) JOIN of_lang l USING (lang) JOIN totals t ON t.lang = s.lang AND t.source = s.source
    LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, CAST(coalesce(d.value, 0) AS BIGINT) AS value
    FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) d
      ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
found AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50""",
}
