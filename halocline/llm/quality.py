"""Document quality from a linear-chain conditional random field over lines.

Every non-blank line is good or bad.  A line's potential is linear in its own features and those of the lines
before and after it; neighbouring states have transition weights.  Training takes the lines of labelled
documents, each with its document's label, from a bounded sample (``max_docs``) and maximises the regularised
likelihood.  Scoring runs forward-backward over whole documents; a document's quality is the mean of its lines'
marginals, weighted by their lengths, on a scale fitted to the training labels.

Forward and backward messages are prefix products of 2 x 2 matrices, so all lines of a batch of documents are
handled together in about log2(lines) vector steps.

Edge cases: texts without a non-blank line score 0; null ids are never trained on and never held out; repeated
rows are scored each; without labelled rows of both classes every other text scores 0.5; further columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halocline.llm.common import in_train_folds, local_text, read_table, small_batches, word_hashes

#: Labelled documents that the model is fitted on, at most; chosen by a hash of their id.
MAX_DOCS = 2_000
THRESHOLD = 0.7
OWN = 13  # features of a line itself
STEPS = 100

CLASS = np.zeros((6, 256), bool)  # letters, capitals, !, |, marks, digits
CLASS[0, 65:91] = CLASS[0, 97:123] = CLASS[0, 128:] = True
CLASS[1, 65:91] = True
CLASS[2, ord("!")] = True
CLASS[3, ord("|")] = True
CLASS[4, list(b"#$%&*@^~<>{}\\=+_")] = True
CLASS[5, 48:58] = True
BLANK = np.zeros(256, bool)
BLANK[list(b" \t\r\x0b\x0c")] = True


def line_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, length in bytes, row) of the non-blank lines of a batch of texts, in order."""
    offsets, data = local_text(column)
    n = len(data)
    stop = np.unique(np.concatenate((np.flatnonzero(data == 10), offsets[1:]))) if n else np.zeros(0, np.int64)
    start = np.concatenate(([0], stop[:-1])) if n else stop
    start = np.where((start < n) & (data[np.minimum(start, n - 1)] == 10), start + 1, start) if n else start
    solid = np.concatenate(([0], np.cumsum(~BLANK[data] & (data != 10))))
    keep = (stop > start) & (solid[stop] > solid[start])
    start, stop = start[keep], stop[keep]
    if not len(start):
        return np.zeros((0, OWN), np.float32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.searchsorted(offsets, start, side="right") - 1
    length = stop - start

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[stop] - total[start]

    letters, capitals, shouts, bars, marks, digits = (count(c[data]) for c in CLASS)
    # words: runs between blanks, whose hashes show a word that repeats the one before
    gap = BLANK[data] | (data == 10)
    head = ~gap
    head[1:] &= gap[:-1]
    head[start] = ~gap[start]
    tail = ~gap
    tail[:-1] &= gap[1:]
    tail[stop - 1] = ~gap[stop - 1]
    a, b = np.flatnonzero(head), np.flatnonzero(tail) + 1
    line = np.searchsorted(start, a, side="right") - 1
    h = word_hashes(data, a, b)
    again = np.zeros(len(a), bool)
    again[1:] = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
    words = np.bincount(line, minlength=len(start))
    repeats = np.bincount(line, weights=again, minlength=len(start))
    # a line that its document has had before
    whole = word_hashes(data, start, stop)
    order = np.lexsort((start, whole, row))
    seen = np.zeros(len(start), bool)
    seen[order[1:]] = (whole[order[1:]] == whole[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    first = np.ones(len(start), bool)
    first[1:] = row[1:] != row[:-1]
    x = np.empty((len(start), OWN), np.float32)
    x[:, 0] = 1
    x[:, 1] = np.log1p(length) / 5
    x[:, 2] = capitals / np.maximum(letters, 1)
    x[:, 3] = 4 * np.minimum(shouts / length, 0.5)
    x[:, 4] = 10 * np.minimum(bars / length, 0.2)
    x[:, 5] = 4 * np.minimum(marks / length, 0.5)
    x[:, 6] = digits / length
    x[:, 7] = (length - letters - digits - shouts - bars - marks) / length
    x[:, 8] = repeats / np.maximum(words, 1)
    x[:, 9] = seen
    x[:, 10] = np.minimum(length / np.maximum(words, 1) / 10, 5)
    x[:, 11] = np.isin(data[stop - 1], list(b".?!:;"))
    x[:, 12] = first
    return x, length, row


def with_neighbours(x: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and of the line after; zeros beyond a document's ends."""
    out = np.zeros((len(x), 3 * OWN), np.float32)
    out[:, :OWN] = x
    if len(x) > 1:
        same = (row[1:] == row[:-1])[:, None]
        out[1:, OWN : 2 * OWN] = np.where(same, x[:-1], 0)
        out[:-1, 2 * OWN :] = np.where(same, x[1:], 0)
    return out


def prefix_products(m: np.ndarray, longest: int) -> np.ndarray:
    """Products of the last ``longest`` or more 2 x 2 matrices up to each place, scaled to a largest entry of 1."""
    p = scaled(m.transpose(1, 2, 0))
    step = 1
    while step < longest:
        l, r = p[:, :, :-step], p[:, :, step:]
        q = np.concatenate((p[:, :, :step], np.empty_like(r)), axis=2)
        for i in (0, 1):
            for k in (0, 1):
                q[i, k, step:] = l[i, 0] * r[0, k] + l[i, 1] * r[1, k]
        p = scaled(q)
        step *= 2
    return p.transpose(2, 0, 1)


def scaled(p: np.ndarray) -> np.ndarray:
    return p / np.maximum(np.maximum(p[0, 0], p[0, 1]), np.maximum(p[1, 0], p[1, 1]))


def marginals(scores: np.ndarray, row: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(line is good), and the 2 x 2 marginals of each line and the next of its document (zeros at an end)."""
    n = len(scores)
    if not n:
        return np.zeros(0), np.zeros((0, 2, 2))
    s = np.clip(scores, -30, 30)
    emit = np.stack((np.exp(-s / 2), np.exp(s / 2)), axis=1)
    same = np.zeros(n, bool)
    same[1:] = row[1:] == row[:-1]
    move = np.exp(trans - trans.max())
    m = np.where(same[:, None, None], move[None], 1.0) * emit[:, None, :]
    longest = int(np.diff(np.flatnonzero(np.append(~same, True))).max())  # a document's first line starts afresh
    alpha = prefix_products(m, longest)[:, 0, :]
    back = np.ones((n, 2, 2))
    back[:-1] = np.where(same[1:, None, None], m[1:], 1.0)
    # suffix products are prefix products of the transposes, taken from the end
    beta = prefix_products(back[::-1].transpose(0, 2, 1), longest)[::-1].transpose(0, 2, 1).sum(axis=2)
    good = alpha * beta
    good /= good.sum(axis=1, keepdims=True)
    pair = np.zeros((n, 2, 2))
    if n > 1:
        pair[:-1] = alpha[:-1, :, None] * m[1:] * beta[1:, None, :]
        pair[:-1] /= pair[:-1].sum(axis=(1, 2), keepdims=True)
        pair[:-1][~same[1:]] = 0
    return good[:, 1], pair


class LineCRF:
    """Weights of the potentials, transitions, and the scale of the document score."""

    def __init__(self) -> None:
        self.w = np.zeros(3 * OWN)
        self.trans = np.zeros((2, 2))
        self.scale = (1.0, 0.0)
        self.fitted = False

    def fit(self, x: np.ndarray, length: np.ndarray, row: np.ndarray, label: np.ndarray, steps: int = STEPS, ridge: float = 1e-3) -> LineCRF:
        """x, length, row: of lines, in order; label: 0 or 1 by row.  Both classes weigh the same."""
        if len(np.unique(label)) < 2 or not len(x):
            return self
        z = with_neighbours(x, row).astype(np.float64)
        y = label[row].astype(float)
        weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
        same = np.zeros(len(y), bool)
        same[:-1] = row[1:] == row[:-1]
        first = second = np.zeros(len(self.w) + 4)
        for step in range(1, steps + 1):
            good, pair = marginals(z @ self.w, row, self.trans)
            seen = np.zeros((2, 2))
            for k in (0, 1):
                seen[k, k] = weight[same & (y == k)].sum()
            slope = np.concatenate((z.T @ (weight * (y - good)) - ridge * self.w, (seen - (pair * weight[:, None, None]).sum(axis=0)).ravel() - ridge * self.trans.ravel()))
            first = 0.9 * first + 0.1 * slope
            second = 0.99 * second + 0.01 * slope**2
            move = 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
            self.w += move[:-4]
            self.trans += move[-4:].reshape(2, 2)
        self.fitted = True
        mean = self.documents(x, length, row, len(label), scaled=False)
        has = np.bincount(row, minlength=len(label)) > 0
        self.scale = fit_scale(mean[has], label[has])
        return self

    def documents(self, x: np.ndarray, length: np.ndarray, row: np.ndarray, rows: int, scaled: bool = True) -> np.ndarray:
        """Quality of each row's document; 0 where it has no line."""
        total = np.bincount(row, weights=length, minlength=rows)
        if not self.fitted:
            return np.where(total > 0, 0.5, 0.0)
        good, _ = marginals(with_neighbours(x, row) @ self.w, row, self.trans)
        mean = np.bincount(row, weights=good * length, minlength=rows) / np.maximum(total, 1)
        if scaled:
            mean = 1 / (1 + np.exp(-(self.scale[0] * (mean - 0.5) + self.scale[1])))
        return np.where(total > 0, mean, 0.0)


def fit_scale(score: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset of a logistic scale, by Newton steps with a small ridge."""
    z = np.stack((score - 0.5, np.ones(len(score))), axis=1)
    v = np.array([4.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ v, -30, 30)))
        grad = z.T @ (label - p) - np.array([0.01, 0.0]) * v
        hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag([0.01, 1e-6])
        v = np.clip(v + np.linalg.solve(hess, grad), [0.5, -10], [40, 10])
    return float(v[0]), float(v[1])


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> LineCRF:
    """Fit on at most ``max_docs`` labelled documents outside the held-out fold; only line features reach the driver."""
    taught = labels.where(F.col("quality").isNotNull() & in_train_folds()).groupBy(F.col("doc_id").alias("id_")).agg(F.max("quality").cast("int").alias("label_"))
    taught = taught.orderBy(F.xxhash64("id_"), "id_").limit(max_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            x, length, row = line_features(batch.column(1))
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
            parts = [(x[a:b].tobytes(), length[a:b].astype(np.int64).tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p[0] for p in parts], pa.binary()), pa.array([p[1] for p in parts], pa.binary()), batch.column(2)], ["doc_id", "x", "length", "label"])

    picked = docs.select("doc_id", "text").join(F.broadcast(taught), F.col("doc_id") == F.col("id_"))  # at most max_docs ids
    # of rows that share an id, the text of the least hash teaches
    picked = picked.groupBy("doc_id", "label_").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = picked.select("doc_id", "text", "label_").mapInArrow(run, "doc_id long, x binary, length binary, label int").collect()
    rows = sorted(rows, key=lambda r: (r.doc_id, bytes(r.x)))
    xs = [np.frombuffer(r.x, np.float32).reshape(-1, OWN) for r in rows]
    if not rows:
        return LineCRF()
    row = np.repeat(np.arange(len(rows)), [len(x) for x in xs])
    return LineCRF().fit(np.concatenate(xs), np.concatenate([np.frombuffer(r.length, np.int64) for r in rows]), row, np.array([r.label for r in rows]))


def score(docs: DataFrame, model: LineCRF) -> DataFrame:
    """(doc_id, score): a row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            x, length, row = line_features(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.documents(x, length, row, batch.num_rows))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: LineCRF, threshold: float = THRESHOLD) -> DataFrame:
    """The documents of at least that quality, all columns kept; each task judges its own rows."""
    at, schema = docs.columns.index("text"), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, at):
            x, length, row = line_features(batch.column(at))
            yield batch.filter(pa.array(model.documents(x, length, row, batch.num_rows) >= threshold))

    return docs.mapInArrow(run, schema)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(~in_train_folds(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
