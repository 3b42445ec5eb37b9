"""The near-dedup stage of the pipeline: five-word shingles, links at similarity >= 0.8, each verified on whole texts.

Two texts link when the Jaccard similarity of their sets of word shingles reaches SIMILARITY, and of the texts that links
join one stays.  Links are proposed

* by op8's SimHash operator over the same shingles: equal fingerprints and BK-tree links within its radius, which
  finds copies with few changes; and
* by BANDS keys of ROWS minimal hashes each, for the links that differ in more bits: a pair of similarity 0.8 shares
  a key but for 7 in 100,000, a closer pair more surely.

A proposed pair is compared by size and by two bits of each minimal hash first (a pair of similarity 0.8 passes but for
1 in 10,000), and what passes on the whole texts.

The texts of one key are a band.  Its hub, the text with the most neighbours, is compared with the others, which joins a
large group of copies at one comparison a copy.  Texts of similarity 1/2 or more to a hub are its spokes and keep their
shingles that it has not, and its shingles that they have not: the differences of two spokes tell their own similarity
exactly, so all links between spokes are found in tasks, without their texts and without a row for pairs that do not link.
Texts that are no spoke of a band's hub meet the band, in pieces of at most MEET texts, and propose their closest candidates
of other groups first; rounds go on until no text has a candidate left.  Pairs within a group need no comparison.

A band with very many texts outside its largest group is split first, without losing a link: two texts that link share one
of the rarest fifth of the shingles of each, by one order for all (the rarest shingle that both have is among so many of
either).  So its texts meet by those shingles instead, of which a passage in very many texts is none as long as a fifth of
the text is rarer.  Texts that still share one by the thousands all meet, in pieces of bounded size.  Nothing is capped.

Texts are ordered by their smallest doc_id, then by hash; one without any id comes last.  Of a group the least text stays;
of its rows that with the smallest id, one only where rows repeat.

Edge cases: null, empty and blank texts have no shingles and are copies of each other; fewer words than a shingle give
one shingle of all; words are split and lower-cased as for op8; further columns are kept; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halocline.llm import simhash
from halocline.llm.common import Scratch, materialize, mix, one_row, small_batches, text_or_empty
from halocline.llm.exact_dedup import FILTER_BITS, hit_filter, passes

SHINGLE = 5
SEED = 42
#: 4 / 5: links are counted in whole numbers.
SIMILARITY = (4, 5)
BANDS, ROWS = 24, 5
#: Minimal hashes that must agree in two bits: of 120, a pair of similarity 0.8 has 102, standard deviation 3.9.
AGREE = 87
#: Minimal hashes that agree in two bits from which on a text may be a hub's spoke; below it asks in the band instead.
SPOKE_AGREE = 75
#: Texts of a band that meet in one task, and the most that ask there.
MEET, ASK = 2_000, 20_000
#: More texts than these outside a band's largest group split the band by its texts' rarest shingles.
CROWD = 20_000
#: Candidates that a text proposes in a band in the first round; each further round takes so many times more.
CLOSEST = 16
#: Pairs of one pivot that one task verifies, so that a pivot with very many is dealt to several.
PAIRS_A_TASK = 500
NO_ID = (1 << 63) - 1

_RNG = np.random.default_rng(SEED)
FACTORS = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64)
JOIN = _RNG.integers(0, 1 << 63, ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
LOW_BITS = np.uint64(0x5555555555555555)


def least_hashes(hashes: np.ndarray) -> np.ndarray:
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), 4096):  # bounds the working array of a very long text
        least = np.minimum(least, (hashes[k : k + 4096, None] * FACTORS + OFFSETS).min(axis=0))
    return mix(least)


def bands(least: np.ndarray) -> np.ndarray:
    """A key for each band; equal keys of different bands do not occur but by chance."""
    return mix((least.reshape(BANDS, ROWS) * JOIN).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def sketch(least: np.ndarray) -> np.ndarray:
    """Two bits of each minimal hash, in four words; the last bits are the same for all."""
    two = np.zeros(128, np.uint64)
    two[: BANDS * ROWS] = least & np.uint64(3)
    return (two.reshape(4, 32) << (np.uint64(2) * np.arange(32, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many minimal hashes agree in their two bits, for sketches along the last axis."""
    apart = a ^ b
    return BANDS * ROWS - np.bitwise_count((apart | (apart >> np.uint64(1))) & LOW_BITS).sum(axis=-1, dtype=np.int64)


def shingle_set(text: str | None) -> np.ndarray:
    return np.unique(simhash.shingle_hashes(text, SHINGLE, SEED))


MARKS = "first_ long, key_ long, n_ long, fp_ long, bands_ array<long>, sketch_ array<long>"


def key_of(text: Column) -> Column:
    return F.xxhash64(F.sha2(text, 256))


def marked(texts: DataFrame) -> DataFrame:
    """A row of MARKS for each row (first_, key_, text): size, fingerprint, band keys and sketch of its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2):
            n, fps, keys, sketches = [], [], [], []
            for t in batch.column(2).to_pylist():
                h = simhash.shingle_hashes(t, SHINGLE, SEED)
                least = least_hashes(h)
                fps.append(simhash.majority(h))
                n.append(len(np.unique(h)))
                keys.append(bands(least) if len(h) else least[:1])
                sketches.append(sketch(least))
            arrays = [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(np.array(fps, np.uint64).view(np.int64)), lists(keys), lists(sketches)]
            yield pa.RecordBatch.from_arrays(arrays, ["first_", "key_", "n_", "fp_", "bands_", "sketch_"])

    return texts.select("first_", "key_", "text").mapInArrow(run, MARKS)


def lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).view(np.int64)))


def node(of: str = "") -> Column:
    """A text: its smallest id and the hash of its text, ordered by both."""
    return F.struct(F.col(f"{of}first_").alias("first_"), F.col(f"{of}key_").alias("key_"))


def may_link(a: Column, b: Column) -> Column:
    """Whether texts of these sizes can be similar enough at all."""
    return F.least(a, b) * SIMILARITY[1] >= F.greatest(a, b) * SIMILARITY[0]


def sketches_agree(a: Column, b: Column, least: int) -> Column:
    apart = [F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k))) for k in range(4)]
    differ = [F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(int(LOW_BITS)))) for x in apart]
    return sum(differ[1:], differ[0]) <= BANDS * ROWS - least


def promising(pairs: DataFrame, nodes: DataFrame, least: int = AGREE) -> DataFrame:
    """The pairs (a, b) of nodes, once each, whose sketches agree so far, and whose sizes allow a link where ``least`` is AGREE."""
    own = nodes.select(node().alias("node_"), "n_", "sketch_")
    left = own.select(F.col("node_").alias("a"), F.col("n_").alias("na"), F.col("sketch_").alias("sa"))
    right = own.select(F.col("node_").alias("b"), F.col("n_").alias("nb"), F.col("sketch_").alias("sb"))
    joined = pairs.distinct().join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    sizes = may_link(F.col("na"), F.col("nb")) if least == AGREE else F.lit(True)
    return joined.where(sizes & sketches_agree(F.col("sa"), F.col("sb"), least)).select("a", "b")


def verified(pairs: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) of nodes whose texts (first_, key_, text) link."""
    return compared(pairs, texts, scratch).where("linked").select("a", "b")


def compared(pairs: DataFrame, texts: DataFrame, scratch: Scratch, spokes: bool = False) -> DataFrame:
    """The pairs (a, b) of nodes that link, or with ``spokes`` all of similarity 1/2 or more, with the shingles that differ.

    The pairs of an ``a`` follow its text through one task, or several when there are many, each with one text at a time.
    """
    pairs = scratch.write(pairs)
    some = texts_of(pairs.select(F.explode(F.array("a", "b")).alias("wanted_")), texts, scratch)
    tasks = scratch.write(pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS_A_TASK).cast("int").alias("tasks")))
    dealt = pairs.join(tasks.hint("merge"), "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("tasks")).cast("int").alias("task"))
    right = dealt.join(some.hint("merge"), F.col("b") == F.col("node_")).select("a", "task", F.lit(1).alias("side"), "b", "text")
    left = tasks.join(some.hint("merge"), F.col("a") == F.col("node_")).select("a", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), F.lit(0).alias("side"), F.col("a").alias("b"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(0, np.uint64)
        for batch in small_batches(batches, 3):
            kept, linked, differ = [], [], [np.zeros(0, np.uint64)]
            for k, (side, text) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                if side == 0:
                    own = shingle_set(text)
                    continue
                other = shingle_set(text)
                n, both = len(own) + len(other), len(np.intersect1d(own, other, assume_unique=True))
                # both / (n - both) >= p / q
                link = both * (SIMILARITY[0] + SIMILARITY[1]) >= n * SIMILARITY[0]
                if link or (spokes and 3 * both >= n):
                    kept.append(k)
                    linked.append(link)
                    differ.append(np.setxor1d(own, other, assume_unique=True) if spokes else differ[0])
            some = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(linked, pa.bool_()), lists(differ[1:] or differ).slice(0, len(kept))], ["a", "b", "linked", "differ"])

    sides = left.unionByName(right).repartition("a", "task").sortWithinPartitions("a", "task", "side")
    end = "struct<first_: long, key_: long>"
    return scratch.write(sides.select("a", "b", "side", "text").mapInArrow(run, f"a {end}, b {end}, linked boolean, differ array<long>"))


def texts_of(wanted: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(node_, text) of the nodes (wanted_); a filter of fixed size keeps the texts of other nodes where they are."""
    wanted = scratch.write(wanted.distinct())
    words = hit_filter(texts.sparkSession, wanted.select(F.col("wanted_.key_").alias("digest")), FILTER_BITS)
    some = texts.withColumn("digest", F.col("key_")).where(passes(words, FILTER_BITS)).select(node().alias("node_"), "text")
    some = some.join(wanted.hint("merge"), F.col("node_") == F.col("wanted_"), "left_semi")
    return scratch.write(some.groupBy("node_").agg(F.first("text").alias("text")))


def rare_shingles(wanted: DataFrame, nodes: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(band, node_) for the nodes (wanted_): the shingles of which two texts that link share one, each as a band.

    Of n shingles a text has at least 4/5 n in common with a text that it links to, so the rarest common one is among its
    n / 5 + 1 rarest.  Those of no other wanted text count there, but need no band.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2):
            sets = [shingle_set(t) for t in batch.column(2).to_pylist()]
            at = pa.array(np.repeat(np.arange(len(sets)), [len(x) for x in sets]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(np.concatenate(sets).view(np.int64))], ["first_", "key_", "shingle"])

    some = texts_of(wanted, texts, scratch).select("node_.first_", "node_.key_", "text")
    rows = scratch.write(some.mapInArrow(run, "first_ long, key_ long, shingle long").select(node().alias("node_"), "shingle"))
    counts = scratch.write(rows.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1"))
    shared = rows.join(counts.hint("merge"), "shingle").groupBy("node_").agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("shared"))
    own = shared.join(nodes.select(node().alias("node_"), "n_").hint("merge"), "node_")
    first = F.floor(F.col("n_") * (SIMILARITY[1] - SIMILARITY[0]) / SIMILARITY[1]).cast("int") + 1
    own = own.withColumn("rarest", first - (F.col("n_").cast("int") - F.size("shared"))).where("rarest > 0")
    return own.select("node_", F.explode(F.slice("shared", 1, F.col("rarest"))).alias("s")).select(F.xxhash64(F.lit("rare"), "s.shingle").alias("band"), "node_")


def met(members: DataFrame, scratch: Scratch) -> DataFrame:
    """Members (band, node_) of bands with more than one, with the band's size."""
    sizes = scratch.write(members.groupBy("band").agg(F.count("*").alias("size")).where("size > 1"))
    return scratch.write(members.join(sizes.hint("merge"), "band"))


def hubs_of(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(band, a): each band's hub, which has most neighbours in all of its bands together."""
    degree = scratch.write(rows.groupBy("node_").agg(F.sum("size").alias("degree")))
    ranked = rows.join(degree.hint("merge"), "node_").groupBy("band").agg(F.min(F.struct(-F.col("degree"), "node_")).alias("hub"))
    return scratch.write(ranked.select("band", F.col("hub.node_").alias("a")))


def spokes_of(rows: DataFrame, hubs: DataFrame, nodes: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Hubs and texts of their bands that are similar by half or more, with the shingles that differ."""
    pairs = rows.join(hubs.hint("merge"), "band").where("node_ <> a").select("a", F.col("node_").alias("b"))
    return compared(promising(pairs, nodes, SPOKE_AGREE), texts, scratch, spokes=True)


def pieces_of(rows: DataFrame, bands_: DataFrame, asks: Column) -> DataFrame:
    """``rows`` (band, node_, root, ...) dealt to pieces of some MEET members and ASK that ask, so that each that asks meets
    each member once: a text is a member in one row of pieces, and asks in one column."""
    out = rows.join(bands_.hint("merge"), "band").withColumn("pieces", F.ceil(F.col("size") / MEET).cast("int")).withColumn("asks", asks)
    out = out.withColumn("columns", F.greatest(F.lit(1), F.ceil(F.col("askers") / ASK)).cast("int"))
    out = out.withColumn("home", F.pmod(F.xxhash64("node_"), F.col("pieces")).cast("int")).withColumn("own", F.pmod(F.xxhash64("node_", F.lit(1)), F.col("columns")).cast("int"))
    as_member = F.transform(F.sequence(F.lit(0), F.col("columns") - 1), lambda k: F.col("home") * F.col("columns") + k)
    asking = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda k: k * F.col("columns") + F.col("own"))
    out = out.withColumn("piece", F.explode(F.when(F.col("asks"), F.array_union(as_member, asking)).otherwise(as_member)))
    out = out.withColumn("member", F.floor(F.col("piece") / F.col("columns")) == F.col("home")).withColumn("asks", F.col("asks") & (F.col("piece") % F.col("columns") == F.col("own")))
    return out.withColumn("group", F.xxhash64("root")).drop("pieces", "columns", "home", "own", "root", "main", "size", "out", "askers")


def whole_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[slice]]]:
    """Tables of rows and the slices of those pieces (band, piece) that are complete; a piece may span batches."""
    held: pa.Table | None = None
    for batch in simhash.chain_none(batches):
        if batch is not None and batch.num_rows:
            held = pa.concat_tables([*([held] if held is not None else []), pa.Table.from_batches([batch])])
        if held is None or not held.num_rows:
            continue
        keys = [held.column(c).to_numpy() for c in ("band", "piece")]
        new = (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), held.num_rows]
        stop = len(cuts) - 1 if batch is None else len(cuts) - 2
        yield held, [slice(cuts[k], cuts[k + 1]) for k in range(stop)]
        held = held.slice(cuts[stop])


def ragged(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, values) of a list column."""
    lens = pc.list_value_length(column).to_numpy()
    return np.concatenate(([0], np.cumsum(lens))), column.combine_chunks().flatten().to_numpy()


def spoke_links(spokes: DataFrame, roots: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (a, b) between the spokes of each hub, one for each text outside the largest group and each other group that
    it links to; from the differences alone, so that nothing of pairs that do not link leaves a task."""
    own = spokes.select("a").distinct().select(F.col("a").alias("hub"), F.col("a").alias("node_"), F.array().cast("array<long>").alias("differ"))
    rows = spokes.select(F.col("a").alias("hub"), F.col("b").alias("node_"), "differ").unionByName(own).withColumn("band", F.xxhash64("hub"))
    rows = rows.join(roots.hint("merge"), F.col("node_") == F.col("node"), "left").select("band", "node_", "differ", F.coalesce("root", "node_").alias("root"))
    rows = scratch.write(rows.join(nodes.select(node().alias("node_"), "n_").hint("merge"), "node_"))
    sent = pieces_of(rows, outside(rows, scratch), F.col("root") != F.col("main"))
    sent = sent.repartition("band", "piece").sortWithinPartitions("band", "piece", "node_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, slices in whole_pieces(batches):
            at, values = ragged(table.column("differ"))
            first, key, n, group, asks, member = (table.column(c).to_numpy() for c in ("first_", "key_", "n_", "group", "asks", "member"))
            found = [differing(part, at, values, n, group, asks, member) for part in slices]
            a, b = (np.concatenate([np.zeros(0, np.int64), *(f[i] for f in found)]) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (first[a], key[a], first[b], key[b])], ["a_first_", "a_key_", "b_first_", "b_key_"])

    found = sent.select("band", "piece", "node_.first_", "node_.key_", "n_", "differ", "group", "asks", "member")
    return scratch.write(found.mapInArrow(run, "a_first_ long, a_key_ long, b_first_ long, b_key_ long").select(node("a_").alias("a"), node("b_").alias("b")))


def differing(part: slice, at: np.ndarray, values: np.ndarray, n: np.ndarray, group: np.ndarray, asks: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of links between the spokes of one piece, by an inverted list of the shingles in their differences."""
    members = part.start + np.flatnonzero(member[part])
    size = at[members + 1] - at[members]
    owner = np.repeat(np.arange(len(members)), size)
    flat = values[np.repeat(at[members] - np.cumsum(size) + size, size) + np.arange(size.sum())]
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    left, right = [], []
    for i in (part.start + np.flatnonzero(asks[part])).tolist():
        mine = values[at[i] : at[i + 1]]
        low, high = np.searchsorted(flat, mine), np.searchsorted(flat, mine, side="right")
        hits = np.repeat(low - np.cumsum(high - low) + high - low, high - low) + np.arange((high - low).sum())
        apart = len(mine) + size - 2 * np.bincount(owner[hits], minlength=len(members))
        whole = n[i] + n[members]
        # both = (whole - apart) / 2, and both / (whole - both) >= p / q
        links = np.flatnonzero(((whole - apart) * (SIMILARITY[0] + SIMILARITY[1]) >= 2 * whole * SIMILARITY[0]) & (group[members] != group[i]))
        links = members[links[np.unique(group[members[links]], return_index=True)[1]]]
        left.append(np.full(len(links), i))
        right.append(links)
    return tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in (left, right))


def grouped(rows: DataFrame, links: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``rows`` with the root of each text's group, and the roots (node, root) of all texts that have links."""
    roots = scratch.write(simhash.components(links, scratch.write))
    return scratch.write(rows.join(roots.hint("merge"), F.col("node_") == F.col("node"), "left").select(*rows.columns, F.coalesce("root", "node_").alias("root"))), roots


def outside(rows: DataFrame, scratch: Scratch, asks: Column | None = None) -> DataFrame:
    """(band, main, size, out, askers): each band's largest group, its size, and how many texts are outside that group and
    ask; without ``asks`` those outside do."""
    counts = rows.groupBy("band", "root").agg(F.count("*").alias("n"), F.count_if(F.lit(False) if asks is None else asks).alias("k"))
    bands_ = counts.groupBy("band").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.sum("n").alias("size"), F.max("n").alias("most"), F.sum("k").alias("askers"))
    out = F.col("size") - F.col("most")
    return scratch.write(bands_.where("size > most").select("band", "main", "size", out.alias("out"), (out if asks is None else F.col("askers")).alias("askers")))


def meetings(rows: DataFrame, bands_: DataFrame, nodes: DataFrame, closest: int, scratch: Scratch) -> DataFrame:
    """(a, b, more): the closest candidates of each text that is no spoke of its band's hub, and whether it has others."""
    own = nodes.select(node().alias("node_"), "n_", "sketch_")
    sent = pieces_of(rows, bands_, ~F.col("spoke")).join(own.hint("merge"), "node_")
    sent = sent.repartition("band", "piece").sortWithinPartitions("band", "piece", "node_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, slices in whole_pieces(batches):
            cols = {c: table.column(c).to_numpy() for c in table.column_names if c != "sketch_"}
            sketches = ragged(table.column("sketch_"))[1].view(np.uint64).reshape(-1, 4)
            found = [candidates(part, cols, sketches, closest) for part in slices]
            a, b, more = (np.concatenate([np.zeros(0, np.int64), *(f[i] for f in found)]) for i in range(3))
            arrays = [cols[c][x] for x in (a, b) for c in ("first_", "key_")]
            yield pa.RecordBatch.from_arrays([*map(pa.array, arrays), pa.array(more.astype(bool))], ["a_first_", "a_key_", "b_first_", "b_key_", "more"])

    pairs = sent.select("band", "piece", "node_.first_", "node_.key_", "group", "asks", "member", "n_", "sketch_")
    pairs = pairs.mapInArrow(run, "a_first_ long, a_key_ long, b_first_ long, b_key_ long, more boolean")
    ends = node("a_"), node("b_")
    return scratch.write(pairs.groupBy(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).agg(F.max("more").alias("more")))


def candidates(own: slice, cols: dict[str, np.ndarray], sketches: np.ndarray, closest: int) -> tuple[np.ndarray, ...]:
    """Places (a, b, more) of the closest promising candidates, of other groups, for each text of a piece that asks."""
    asks, members = own.start + np.flatnonzero(cols["asks"][own]), own.start + np.flatnonzero(cols["member"][own])
    n, group = cols["n_"], cols["group"]
    out = [[np.zeros(0, np.int64)] for _ in range(3)]
    for i in asks.tolist():
        j = members[group[members] != group[i]]
        j = j[np.minimum(n[i], n[j]) * SIMILARITY[1] >= np.maximum(n[i], n[j]) * SIMILARITY[0]]
        agree = agreeing(sketches[i], sketches[j])
        near = np.flatnonzero(agree >= AGREE)
        near = near[np.argsort(-agree[near], kind="stable")[:closest]]
        out[0].append(np.full(len(near), i))
        out[1].append(j[near])
        out[2].append(np.full(len(near), int((agree >= AGREE).sum() > closest)))
    return tuple(np.concatenate(x) for x in out)


def near_fingerprints(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) by op8's operator: equal fingerprints, and a spanning forest of those within its radius."""
    first = scratch.write(nodes.groupBy("fp_").agg(F.min(node()).alias("least")))
    equal = nodes.select("fp_", node().alias("b")).join(first.hint("merge"), "fp_").where("b <> least").select(F.col("least").alias("a"), "b")
    edges = scratch.write(simhash.links(first.select(F.col("fp_").alias("fp")), write=scratch.write).select(F.col("a").alias("fa"), F.col("b").alias("fb")))
    ends = [first.select(F.col("fp_").alias(f), F.col("least").alias(x)) for f, x in (("fa", "a"), ("fb", "b"))]
    near = edges.join(ends[0].hint("merge"), "fa").join(ends[1].hint("merge"), "fb").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return equal.unionByName(near)


def near_copies(nodes: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """The nodes (first_, key_) to drop; ``texts`` (first_, key_, text) has their texts."""
    every = nodes.select(node().alias("node_"), "bands_")
    links = verified(promising(near_fingerprints(nodes, scratch), nodes), texts, scratch)
    members = met(every.select("node_", F.explode("bands_").alias("band")), scratch)
    hubs = hubs_of(members, scratch)
    spokes = spokes_of(members, hubs, nodes, texts, scratch)
    links = links.unionByName(spokes.where("linked").select("a", "b"))
    rows, roots = grouped(members, links, scratch)
    crowded = outside(rows, scratch).where(F.col("out") > CROWD).select("band")
    if not crowded.isEmpty():
        many = rows.join(crowded.hint("merge"), "band", "left_semi").select(F.col("node_").alias("wanted_"))
        finer = met(rare_shingles(many, nodes, texts, scratch), scratch)
        more = hubs_of(finer, scratch)
        members = members.join(crowded.hint("merge"), "band", "left_anti").select("band", "node_").unionByName(finer.select("band", "node_"))
        again = spokes_of(finer, more, nodes, texts, scratch).join(spokes.select("a", "b").hint("merge"), ["a", "b"], "left_anti")
        hubs, spokes = hubs.unionByName(more), scratch.write(spokes.unionByName(again.select(*spokes.columns)))
        links = links.unionByName(spokes.where("linked").select("a", "b"))
        rows, roots = grouped(members, links, scratch)
    links = links.unionByName(spoke_links(spokes, roots, nodes, scratch))
    # who is a spoke of its band's hub, or the hub, has met the band's other spokes
    hub_of = members.select("band", "node_").join(hubs.hint("merge"), "band")
    own = spokes.select("a", F.col("b").alias("node_"), F.lit(True).alias("spoke"))
    known = scratch.write(hub_of.join(own.hint("merge"), ["a", "node_"], "left").select("band", "node_", F.coalesce("spoke", F.col("a") == F.col("node_")).alias("spoke")))
    rows, roots = grouped(known, links, scratch)
    tried, closest = None, CLOSEST
    while True:
        bands_ = outside(rows, scratch, ~F.col("spoke"))
        found = meetings(rows, bands_, nodes, closest, scratch)
        pairs = found.select("a", "b")
        pairs = scratch.write(pairs if tried is None else pairs.join(tried.hint("merge"), ["a", "b"], "left_anti"))
        links = links.unionByName(verified(pairs, texts, scratch))
        tried = pairs if tried is None else tried.unionByName(pairs)
        rows, roots = grouped(known, links, scratch)
        if found.where("more").isEmpty():  # all candidates of different groups have been compared
            return roots.where("node <> root").select("node.first_", "node.key_")
        closest *= CLOSEST


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies, that with the smallest id; all columns kept."""
    scratch = Scratch(docs.sparkSession)
    text = text_or_empty()
    blank = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rows = docs.select(F.col("doc_id").cast("long").alias("id_"), F.when(blank, F.lit(0).cast("long")).otherwise(key_of(text)).alias("key_"), "text", F.struct(*docs.columns).alias("row_"))
    texts = rows.select(F.coalesce("id_", F.lit(NO_ID)).alias("first_"), "key_", "text")
    # of rows of one text that with the smallest id is its node; size and fingerprint guard against equal hashes
    own = [F.first(c).alias(c) for c in ("bands_", "sketch_")]
    nodes = scratch.write(marked(texts).groupBy("key_", "n_", "fp_").agg(F.min("first_").alias("first_"), *own))
    gone = near_copies(nodes, texts, scratch)
    stay = materialize(nodes.select("first_", "key_").join(gone.hint("merge"), ["first_", "key_"], "left_anti"))
    scratch.clear()
    kept = rows.select("row_", F.coalesce("id_", F.lit(NO_ID)).alias("first_"), "key_").join(stay.hint("merge"), ["first_", "key_"])
    return one_row(kept, ["key_"], "row_").select("row_.*")
