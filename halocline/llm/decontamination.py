"""Benchmark decontamination by winnowing.

Of every window of w consecutive k-gram hashes the smallest is selected (the last of equal ones), in the benchmark and
in the documents alike, so two texts that share k + w - 1 words share a selected k-gram there.  Only selected k-grams
are kept and looked up.  A hit, a place of a document whose hash the benchmark has, is extended to the windows around it;
equal windows of the benchmark are one class, whose items are a list, and a document's window is looked up by the hash of
its words and compared byte by byte with its class.  So the work at a hit does not depend on how many items share a
passage.  With k = 5 and w = 6 every shared span of 10 words is found.  An item of fewer words is one k-gram of all of them
(k its length, w = 1).

The benchmark's selected places are sent to all tasks in blocks of bounded text, one block after the other: a block is
built, sent, used over all documents and given back before the next one.  With one block nothing is shuffled or
written.

Edge cases: a null or empty text has no words; repeated document rows give a row each; repeated or null item
ids count once each (a null id is left out); items without words have no windows; further columns are ignored;
empty tables give no rows, or rows without hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halocline.llm.common import LOWER, local_text, materialize, mix, read_table, small_batches, word_hashes, word_spans

WINDOW = 10
KGRAM = 5
#: Bytes of benchmark text sent to the tasks at once (one longer item is a block of its own); a larger benchmark takes
#: several passes over the documents.
BLOCK_BYTES = 8_000_000
#: Pairs of windows that are compared at once inside a task.
PAIRS_AT_ONCE = 1_000_000

GRAM_MULT = 0xD6E8FEB86659FD93


class Words:
    """The words of a column of texts: lower-cased bytes, bounds, row and hash of each word."""

    def __init__(self, column: pa.Array) -> None:
        offsets, data = local_text(column)
        self.data = LOWER[data]
        self.start, self.end, self.row = word_spans(self.data, offsets)
        self.hashes = word_hashes(self.data, self.start, self.end)

    @classmethod
    def of_items(cls, texts: list[str]) -> Words:
        """Those of many texts, a bounded number of bytes at once."""
        parts, bytes_before, rows_before = [], 0, 0
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])
        for small in small_batches([batch], 0):
            part = cls(small.column(0))
            parts.append((part.data, part.start + bytes_before, part.end + bytes_before, part.row + rows_before, part.hashes))
            bytes_before, rows_before = bytes_before + len(part.data), rows_before + small.num_rows
        out = cls.__new__(cls)
        out.data, out.start, out.end, out.row, out.hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
        return out

    def __len__(self) -> int:
        return len(self.start)

    def begins(self, n: int) -> np.ndarray:
        """The places from which n words follow in the same row."""
        if len(self) < n:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.row[: len(self) - n + 1] == self.row[n - 1 :])


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on, rows left out of account."""
    m = len(hashes) - n + 1
    h = hashes[:m].copy()
    for j in range(1, n):
        h *= np.uint64(GRAM_MULT)
        h += hashes[j : j + m]
    return mix(h)


def winnow(words: Words, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the selected k-grams: the least of each window of w, once each."""
    whole = words.begins(k + w - 1)
    if not len(whole):
        return whole, np.zeros(0, np.uint64)
    gram = gram_hashes(words.hashes, k)
    m = len(gram) - w + 1
    least, at = gram[:m].copy(), np.arange(m)
    for j in range(1, w):
        later = gram[j : j + m]
        lower = later <= least
        np.copyto(least, later, where=lower)
        np.copyto(at, np.arange(j, j + m), where=lower)
    at = at[whole]
    at = at[np.append(True, at[1:] != at[:-1])]  # places do not go back from one window to the next
    return at, gram[at]


def same_bytes(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether word i of ``a`` is word j of ``b``, byte by byte."""
    size = a.end[i] - a.start[i]
    same = size == b.end[j] - b.start[j]
    some = np.flatnonzero(same)
    if len(some):
        lens = size[some]
        first = np.cumsum(lens) - lens
        inside = np.arange(lens.sum()) - np.repeat(first, lens)
        equal = a.data[np.repeat(a.start[i[some]], lens) + inside] == b.data[np.repeat(b.start[j[some]], lens) + inside]
        same[some] = np.logical_and.reduceat(equal, first)
    return same


def same_windows(a: Words, i: np.ndarray, b: Words, j: np.ndarray, n: int) -> np.ndarray:
    """Whether the n words from i on in ``a`` are those from j on in ``b``; a bounded number is compared at once."""
    same = np.ones(len(i), bool)
    for at in range(0, len(i), PAIRS_AT_ONCE // 10):
        part = slice(at, at + PAIRS_AT_ONCE // 10)
        for k in range(n):
            left = at + np.flatnonzero(same[part])
            same[left] = same_bytes(a, i[left] + k, b, j[left] + k)
    return same


def window_classes(words: Words, begins: np.ndarray, n: int) -> np.ndarray:
    """A number for each window, the same for equal windows only: windows of equal hash are compared byte by byte."""
    out = np.full(len(begins), -1)
    hashes = gram_hashes(words.hashes, n)[begins] if len(begins) else np.zeros(0, np.uint64)
    left, used = np.arange(len(begins)), 0
    while len(left):
        _, first, inverse = np.unique(hashes[left], return_index=True, return_inverse=True)
        same = np.ones(len(left), bool)
        again = np.flatnonzero(first[inverse] != np.arange(len(left)))
        same[again] = same_windows(words, begins[left[again]], words, begins[left[first[inverse[again]]]], n)
        out[left[same]] = used + inverse[same]
        used += len(first)
        left = left[~same]
    return out


class Index:
    """The windows of items that share a window length, and their selected places sorted by hash."""

    def __init__(self, items: list[tuple[str, str]], n: int) -> None:
        self.n = n
        self.k, self.w = (KGRAM, WINDOW - KGRAM + 1) if n == WINDOW else (n, 1)
        self.words = words = Words.of_items([t for _, t in items])
        begins = words.begins(n)
        classes = window_classes(words, begins, n)
        self.classes = np.full(len(words), -1)
        self.classes[begins] = classes
        # a class's items, as a number of a list: the windows of a passage that items share have the same list
        owned = np.unique(classes * len(items) + words.row[begins])
        owner, cls = owned % len(items), owned // len(items)
        first = np.flatnonzero(np.append(True, cls[1:] != cls[:-1]))
        self.class_list = owner[first]  # list i is item i alone
        lists: dict[tuple[int, ...], int] = {}
        stops = np.append(first[1:], len(owner))
        for c in np.flatnonzero(stops - first > 1).tolist():
            self.class_list[c] = len(items) + lists.setdefault(tuple(owner[first[c] : stops[c]].tolist()), len(lists))
        self.lists = [(i,) for i, _ in items] + [tuple(items[i][0] for i in own) for own in lists]
        # one window of each class, found by the hash of its words
        _, first = np.unique(classes, return_index=True)
        hashes = gram_hashes(words.hashes, n)[begins[first]] if len(begins) else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.window_hashes, self.window_classes, self.window_places = hashes[order], order, begins[first][order]
        # a selected k-gram is kept once, in however many items it stands
        at, prints = winnow(words, self.k, self.w)
        self.prints, once = np.unique(prints, return_index=True)
        self.at = at[once]
        bits = max(20, int(8 * len(self.at)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.filter = np.zeros(1 << bits, bool)
        self.filter[self.prints & self.mask] = True

    def hits(self, words: Words) -> np.ndarray:
        """Places in ``words`` of selected k-grams that are selected in the items too."""
        at, prints = winnow(words, self.k, self.w)
        maybe = np.flatnonzero(self.filter[prints & self.mask])
        at, prints = at[maybe], prints[maybe]
        if not len(self.prints):
            return at[:0]
        found = np.minimum(np.searchsorted(self.prints, prints), len(self.prints) - 1)
        return at[self.prints[found] == prints]

    def shared(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(place, class) of the windows that ``words`` shares with the items, once each, by place.

        Each hit is extended to the windows around it, at most as many as a window has k-grams.  A window is looked up among
        the classes by the hash of all its words, however many items it stands in, and compared byte by byte.
        """
        at = self.hits(words)
        whole = np.zeros(len(words) + 1, bool)
        whole[words.begins(self.n)] = True
        around = at[:, None] - np.arange(self.w)
        place = np.unique(around[around >= 0])
        place = place[whole[place]]
        if not len(place):
            return place, place
        hashes = gram_hashes(words.hashes, self.n)[place]
        low, high = np.searchsorted(self.window_hashes, hashes), np.searchsorted(self.window_hashes, hashes, side="right")
        n = high - low  # of several classes of one hash at most one has these words
        found = [np.zeros((2, 0), np.int64)]
        step = np.cumsum(n) // PAIRS_AT_ONCE
        for own in np.split(np.arange(len(n)), np.flatnonzero(np.diff(step)) + 1):
            first = np.cumsum(n[own]) - n[own]
            here, there = np.repeat(place[own], n[own]), np.repeat(low[own] - first, n[own]) + np.arange(n[own].sum())
            same = same_windows(words, here, self.words, self.window_places[there], self.n)
            found.append(np.stack((here[same], self.window_classes[there[same]])))
        pairs = np.concatenate(found, axis=1)
        return pairs[0], pairs[1]


def build_indexes(items: list[tuple[str, str]]) -> list[Index]:
    """The indexes of a block of (item_id, text), one for each window length."""
    if not items:
        return []
    n_words = np.bincount(Words.of_items([t for _, t in items]).row, minlength=len(items))
    lengths = np.minimum(n_words, WINDOW)
    return [Index([items[i] for i in np.flatnonzero(lengths == n)], n) for n in np.unique(lengths[lengths > 0]).tolist()]


def find_spans(texts: pa.Array, block: list[Index]) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[list[str]]]:
    """Per row: its number of words, the word spans [start, end) it shares with items, and those items."""
    words = Words(texts)
    n_words = np.bincount(words.row, minlength=len(texts))
    first = np.cumsum(n_words) - n_words
    spans: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
    items: list[set[str]] = [set() for _ in range(len(texts))]
    for index in block:
        place, cls = index.shared(words)
        if not len(place):
            continue
        row = words.row[place]
        fresh = np.flatnonzero(np.append(True, (place[1:] > place[:-1] + index.n) | (row[1:] != row[:-1])))
        stop = place[np.append(fresh[1:], len(place)) - 1] + index.n
        for r, a, b in zip(row[fresh].tolist(), place[fresh].tolist(), stop.tolist(), strict=True):
            spans[r].append((a - int(first[r]), b - int(first[r])))
        for key in np.unique(row * len(index.lists) + index.class_list[cls]).tolist():
            items[key // len(index.lists)].update(index.lists[key % len(index.lists)])
    return n_words, [merged(s) for s in spans], [sorted(x) for x in items]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, as disjoint spans in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


SCHEMA = "doc_id long, text_sha256 string, n_words long, spans array<array<long>>, items array<string>"


def sent_blocks(spark: SparkSession, benchmark: DataFrame, block_bytes: int) -> Iterator[tuple]:
    """(broadcast of a block's indexes, whether it is the last), built as they are asked for."""
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()  # about block_bytes of text
        yield spark.sparkContext.broadcast(build_indexes([(r.item_id, r.text) for r in part])), k == blocks - 1


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row per document: doc_id, n_words, spans (of words shared with items) and items (ids as strings)."""
    rows, found = None, []
    for sent, last in sent_blocks(docs.sparkSession, benchmark, block_bytes):
        if rows is None and last:
            return search(docs, sent).drop("text_sha256")
        if rows is None:  # the first of several blocks: its pass also counts words
            first = materialize(search(docs, sent))
            rows, hits = first.select("doc_id", "text_sha256", "n_words"), first.where("size(spans) > 0")
        else:
            hits = search(docs, sent).where("size(spans) > 0")
        found.append(materialize(hits.select("doc_id", "text_sha256", "spans", "items").distinct()))
        sent.unpersist()
    # rows of equal id and text have equal results
    each = reduce(DataFrame.unionByName, found).groupBy("doc_id", "text_sha256").agg(F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    united = F.aggregate(
        "spans",
        F.array().cast("array<array<bigint>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.get(F.element_at(acc, -1), F.lit(1)) >= s[0]),
            F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.array(F.element_at(acc, -1)[0], F.greatest(F.element_at(acc, -1)[1], s[1])))),
        ).otherwise(F.concat(acc, F.array(s))),
    )
    each = materialize(each.select(F.col("doc_id").alias("id_"), F.col("text_sha256").alias("sha_"), united.alias("spans"), "items"))
    joined = rows.join(each.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("text_sha256") == F.col("sha_")), "left")
    return joined.select("doc_id", "n_words", F.coalesce("spans", F.array().cast("array<array<bigint>>")).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def search(docs: DataFrame, sent) -> DataFrame:
    """One pass: documents against one block of the benchmark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        for batch in small_batches(batches, 1):
            n_words, spans, items = find_spans(batch.column(1), block)
            arrays = [batch.column(0), batch.column(2), pa.array(n_words, pa.int64()), pa.array([[list(s) for s in x] for x in spans], pa.list_(pa.list_(pa.int64()))), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_sha256", "n_words", "spans", "items"])

    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", sha.alias("text_sha256")).mapInArrow(run, SCHEMA)


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that share no window with the benchmark, all columns kept.

    Map-only: each task judges its own rows, so repeated or null ids need no join.  Between two blocks of a large
    benchmark what is left of the documents is written to the shared folder.
    """
    at = docs.columns.index("text")
    schema = docs.schema
    for sent, last in sent_blocks(docs.sparkSession, benchmark, block_bytes):

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for batch in small_batches(batches, at):
                spans = find_spans(batch.column(at), block)[1]
                yield batch.filter(pa.array([not s for s in spans], pa.bool_()))

        docs = docs.mapInArrow(run, schema)
        if not last:
            docs = materialize(docs)
            sent.unpersist()
    return docs


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated_spans(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s[1] - s[0])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS_SQL = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWERED}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL = {
    "op3_decontamination": f"""
        WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
        b AS (SELECT item_id::VARCHAR AS item_id, w, least(len(w), {WINDOW}) AS n FROM (SELECT item_id, {WORDS_SQL} AS w FROM benchmark)),
        bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM b, unnest(generate_series(1, len(w) - n + 1)) AS t(i) WHERE n > 0),
        lengths AS (SELECT DISTINCT n FROM bw),
        dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM d, lengths, unnest(generate_series(1, len(w) - n + 1)) AS t(i)),
        hits AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, k)),
        places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)"""
}
