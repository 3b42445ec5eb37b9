import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from halocline.llm.toxicity import PUModel, fit, op7_toxicity, rows_words, score, train

SF = "/root/testdata/sf0.1"


def test_words():
    texts = ["A b, ä-Ä\n9", None, "", "b\x00b", "é"]
    row, h = rows_words(pa.array(texts))
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    plain = [(r, w) for r, t in enumerate(texts) for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(low))]
    assert row.tolist() == [r for r, _ in plain]
    assert len(set(h.tolist())) == len({w for _, w in plain})
    assert all((h[i] == h[j]) == (plain[i][1] == plain[j][1]) for i in range(len(h)) for j in range(len(h)))


def test_nonnegative_risk_recovers_the_prior():
    rng = np.random.default_rng(0)
    common, bad = np.arange(1, 200, dtype=np.uint64), np.arange(1000, 1010, dtype=np.uint64)

    def doc(toxic):
        words = rng.choice(common, 30)
        return np.unique(np.concatenate((words, rng.choice(bad, 3) if toxic else words[:0])))

    positive = [doc(True) for _ in range(300)]
    unlabelled = [doc(k % 10 == 0) for k in range(3000)]
    model = fit(positive, unlabelled, 0.1)
    test = [doc(k % 2 == 0) for k in range(400)]
    scores = np.array([model.score(np.zeros(len(w), np.int64), w, 1)[0] for w in test])
    assert np.mean((scores >= 0.3) == (np.arange(400) % 2 == 0)) > 0.98
    every = np.array([model.score(np.zeros(len(w), np.int64), w, 1)[0] for w in unlabelled])
    assert abs(np.mean(every >= 0.5) - 0.1) < 0.02


def test_edges(spark):
    df = spark.createDataFrame([(1, "", 1), (None, None, 1), (3, "word " * 90000, 1), (3, "word", 1)], "doc_id long, text string, score int")
    none = PUModel(np.zeros(0, np.uint64), np.zeros(0), 0.0)
    assert [r.score for r in score(df, none).collect()] == [0.5] * 4
    labels = spark.createDataFrame([(1, 0), (3, None)], "doc_id long, toxic int")
    model = train(df, labels)
    assert not len(model.words) and max(r.score for r in score(df, model).collect()) < 1e-4
    assert score(df.limit(0), none).count() == 0


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in op7_toxicity(spark, SF).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for d, r in rows.items())
    held = [(r.predicted, labels[d]) for d, r in rows.items() if r.held_out and d in labels]
    hits = sum(p and t for p, t in held)
    assert hits / sum(p for p, _ in held) > 0.9 and hits / sum(t for _, t in held) > 0.8


def test_an_id_of_many_rows_is_one_of_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr("halocline.llm.toxicity.fit", lambda positive, unlabelled, prior: seen.append((len(positive), len(unlabelled))))
    docs = spark.createDataFrame([(i, f"word{i}") for i in range(40)] + [(i % 4, f"other{i}") for i in range(400)], "doc_id long, text string")
    train(docs, spark.createDataFrame([(0, 1), (1, 1), (2, 1), (3, 1), (9, 0)], "doc_id long, toxic int"), max_unlabelled=20)
    assert seen == [(sum(zlib.crc32(str(d).encode()) % 4 != 2 for d in range(4)), 20)]


def test_score_against_a_plain_version(spark):
    """Every document of a table, word by word in Python; the model's words are told by their hash."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(-1, None), (-2, ""), (-3, "?!"), (-4, "one " * 5), (-4, "one " * 5)]
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    weight = dict(zip(model.words.tolist(), model.weights.tolist(), strict=True))

    def plain(text):
        words = sorted({w for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(low))})
        hashes = [int(rows_words(pa.array([w]))[1][0]) for w in words]
        return 1 / (1 + np.exp(-(model.bias + sum(weight.get(h, 0.0) for h in hashes))))

    got = sorted((r.doc_id, r.score) for r in score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect())
    expected = sorted((d, plain(t)) for d, t in rows)
    assert len(weight) > 3 and [d for d, _ in got] == [d for d, _ in expected]
    np.testing.assert_allclose([v for _, v in got], [v for _, v in expected], rtol=1e-9)


def test_no_held_out_row_teaches(spark):
    """Labels and texts of held-out rows may be anything: the model stays the same."""
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    other_docs = docs.withColumn("text", F.when(held, F.lit("other words")).otherwise(F.col("text")))
    other_labels = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = train(docs, labels), train(other_docs, other_labels)
    assert a.bias == b.bias and (a.words == b.words).all() and (a.weights == b.weights).all()
