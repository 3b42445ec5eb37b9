"""Toxicity by non-negative positive-unlabelled learning.

Positives are documents confirmed toxic; everything else is unlabelled text, toxic documents included.  A linear
model over the presence of words is fitted with numpy by minimising the non-negative, class-prior-corrected risk

    prior * E_P[l(g, 1)] + max(0, E_U[l(g, 0)] - prior * E_P[l(g, 0)])

with the logistic loss, so its sigmoid is an estimate of the probability.  The class prior is a parameter; by
default it is the share of toxic rows among the labels that may teach.  Samples of positives and of unlabelled
documents are bounded (``max_positive``, ``max_unlabelled``) and chosen by a hash of their id; scoring reads
every word of every document.

VOCABULARY, STEPS, RIDGE, MOST_RIDGE and SURPRISE were chosen by the mean F1 at THRESHOLD of a three-fold split inside
the folds that may teach (tests/llm/choose_toxicity.py has the grid); no held-out row took part.

Edge cases: null, empty and wordless texts get the model's bias alone; labels without a positive give a model
that scores every text at the prior (0 without labels); repeated rows are scored each; null ids are never taught
or held out; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halocline.llm.common import LOWER, in_train_folds, local_text, read_table, small_batches, word_hashes, word_spans

MAX_POSITIVE = 4_000
MAX_UNLABELLED = 8_000
#: Words in the model at most: those most over-represented among the positives.
VOCABULARY = 4_096
THRESHOLD = 0.3
STEPS = 200
#: The ridge is RIDGE by the number of positives, at most MOST_RIDGE: more examples need less of it.
RIDGE, MOST_RIDGE = 0.1, 5e-4
#: Standard errors by which a word's rate among positives must exceed that in unlabelled text.
SURPRISE = 4
#: Bits of the table that keeps most other words from the vocabulary's binary search.
PREFILTER_BITS = 20


def rows_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word of a batch of texts."""
    offsets, data = local_text(column)
    data = LOWER[data]
    start, end, row = word_spans(data, offsets)
    return row, word_hashes(data, start, end)


@dataclass
class PUModel:
    """Words (sorted hashes), a weight for each, and a bias."""

    words: np.ndarray
    weights: np.ndarray
    bias: float

    def features(self, row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, word of the model) pairs."""
        if not len(self.words):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        mask = np.uint64((1 << PREFILTER_BITS) - 1)
        known = np.zeros(1 << PREFILTER_BITS, bool)
        known[self.words & mask] = True
        maybe = np.flatnonzero(known[h & mask])
        at = np.minimum(np.searchsorted(self.words, h[maybe]), len(self.words) - 1)
        hit = self.words[at] == h[maybe]
        pairs = np.unique(row[maybe[hit]] * len(self.words) + at[hit])
        return pairs // len(self.words), pairs % len(self.words)

    def score(self, row: np.ndarray, h: np.ndarray, rows: int) -> np.ndarray:
        r, f = self.features(row, h)
        return sigmoid(self.bias + np.bincount(r, weights=self.weights[f], minlength=rows))


def sigmoid(g: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(g, -30, 30)))


def choose_words(positive: list[np.ndarray], unlabelled: list[np.ndarray], size: int) -> np.ndarray:
    """Words of at least two positives whose document rate there exceeds that of unlabelled text most surely."""
    if not positive:
        return np.zeros(0, np.uint64)
    words, n = np.unique(np.concatenate(positive), return_counts=True)
    words, n = words[n >= 2], n[n >= 2]
    other, m = np.unique(np.concatenate(unlabelled), return_counts=True) if unlabelled else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    at = np.minimum(np.searchsorted(other, words), max(len(other) - 1, 0))
    seen = np.where(other[at] == words, m[at], 0) if len(other) else np.zeros(len(words))
    p, u = n / len(positive), (seen + 0.5) / (len(unlabelled) + 1)
    z = (p - u) / np.sqrt(u * (1 - np.minimum(u, 0.99)) * (1 / len(positive) + 1 / (len(unlabelled) + 1)))
    best = np.argsort(-z, kind="stable")[:size]
    return np.sort(words[best[z[best] > SURPRISE]])


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, size: int = VOCABULARY, steps: int = STEPS) -> PUModel:
    """positive, unlabelled: each document's distinct word hashes."""
    words = choose_words(positive, unlabelled, size)
    model = PUModel(words, np.zeros(len(words)), float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))))
    if not len(words) or not unlabelled:
        return model

    def table(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        return model.features(row, np.concatenate(docs))

    ridge = min(RIDGE / len(positive), MOST_RIDGE)
    (pr, pf), (ur, uf) = table(positive), table(unlabelled)
    first, second = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    for step in range(1, steps + 1):
        gp = model.bias + np.bincount(pr, weights=model.weights[pf], minlength=len(positive))
        gu = model.bias + np.bincount(ur, weights=model.weights[uf], minlength=len(unlabelled))
        sp, su = sigmoid(gp), sigmoid(gu)
        negative = np.mean(np.logaddexp(0, gu)) - prior * np.mean(np.logaddexp(0, gp))
        # slopes of the risk by g: l(g, 1) has s - 1, l(g, 0) has s
        if negative >= 0:
            dp, du = prior * (sp - 1) / len(sp) - prior * sp / len(sp), su / len(su)
        else:  # the estimate of the negatives' risk fell below zero: step back up
            dp, du = prior * sp / len(sp), -su / len(su)
        slope = np.bincount(pf, weights=dp[pr], minlength=len(words)) + np.bincount(uf, weights=du[ur], minlength=len(words)) + ridge * model.weights
        slope = np.append(slope, dp.sum() + du.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        model.weights -= move[:-1]
        model.bias -= move[-1]
    return model


def train(docs: DataFrame, labels: DataFrame, prior: float | None = None, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> PUModel:
    """Fit on the folds that may teach; only distinct word hashes of the sampled documents reach the driver."""
    known = labels.where(F.col("toxic").isNotNull() & in_train_folds()).groupBy(F.col("doc_id").alias("id_")).agg(F.max("toxic").alias("toxic"))
    if prior is None:
        prior = known.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0] or 0.0
    by_hash = (F.xxhash64("id_"), F.col("id_"))
    positive = known.where("toxic > 0").select("id_", F.lit(1).alias("side_")).orderBy(*by_hash).limit(max_positive)
    every = docs.where(in_train_folds()).select(F.col("doc_id").alias("id_")).distinct().orderBy(*by_hash).limit(max_unlabelled).select("id_", F.lit(0).alias("side_"))
    picked = positive.unionByName(every).groupBy("id_").agg(F.collect_set("side_").alias("sides_"))  # at most both limits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 0):
            row, h = rows_words(batch.column(0))
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
            own = [np.unique(h[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), batch.column(1)], ["words", "sides"])

    taken = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("id_"))
    # of rows that share an id, the text of the least hash teaches
    taken = taken.groupBy("id_").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("sides_").alias("sides_")).select("text", "sides_")
    rows = sorted((bytes(r.words), sorted(r.sides)) for r in taken.mapInArrow(run, "words binary, sides array<int>").collect())
    side = [[np.frombuffer(w, np.uint64) for w, s in rows if k in s] for k in (0, 1)]
    return fit(side[1], side[0], prior)


def score(docs: DataFrame, model: PUModel) -> DataFrame:
    """(doc_id, score): a row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            row, h = rows_words(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(row, h, batch.num_rows))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(~in_train_folds(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
