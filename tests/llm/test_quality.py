import zlib

import numpy as np
import pyarrow as pa

from halocline.llm.quality import OWN, LineCRF, line_features, marginals, op10_quality, score, train, with_neighbours


def brute_marginals(scores, trans):
    """P(good) of each line from all 2**n labellings."""
    n = len(scores)
    total, good = 0.0, np.zeros(n)
    for code in range(2**n):
        s = [code >> t & 1 for t in range(n)]
        w = np.exp(sum(scores[t] * (s[t] - 0.5) for t in range(n)) + sum(trans[s[t - 1]][s[t]] for t in range(1, n)))
        total += w
        good += w * np.array(s)
    return good / total


def test_forward_backward():
    rng = np.random.default_rng(0)
    trans = rng.normal(size=(2, 2))
    row = np.repeat([0, 1, 2, 5], [1, 7, 4, 9])
    scores = rng.normal(size=len(row)) * 3
    good, pair = marginals(scores, row, trans)
    for r in np.unique(row):
        assert np.allclose(good[row == r], brute_marginals(scores[row == r], trans))
    assert np.allclose(pair[row == 1][:-1].sum(axis=1)[:, 1], good[row == 1][1:])


def test_line_features_of_lines():
    texts = ["", None, "\n \n", "One two two a.\r\nTHE END!! | a\n\nOne two two a.\r\n", "é" * 50, "\nlast", "x\n"]
    x, length, row = line_features(pa.array(texts))
    lines = [(r, line) for r, t in enumerate(texts) for line in (t or "").split("\n") if line.strip()]
    assert row.tolist() == [r for r, _ in lines] and length.tolist() == [len(line.encode()) for _, line in lines]
    assert x[0, 8] > 0.2 and x[1, 2] > 0.8 and x[1, 4] > 0 and x[:, 9].tolist() == [0, 0, 1, 0, 0, 0]
    for t, (r, line) in enumerate(lines):  # the same alone, but for what the document shows
        alone = line_features(pa.array([line]))[0][0]
        assert np.allclose(np.delete(alone, [9, 12]), np.delete(x[t], [9, 12]))
    z = with_neighbours(x, row)
    assert (z[1, OWN : 2 * OWN] == x[0]).all() and not z[0, OWN : 2 * OWN].any()


def test_edges(spark):
    df = spark.createDataFrame([(1, "", 0.5), (1, "", 0.5), (None, None, None), (2, "a b c\n" * 50000, 1.0)], "doc_id long, text string, score double")
    assert [r.score for r in score(df, LineCRF()).collect()] == [0, 0, 0, 0.5]
    labels = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, quality int")
    assert not train(df, labels).fitted
    assert score(df.limit(0), LineCRF()).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op10_quality(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in rows.items())
    held = [(r.predicted, labels[d]) for d, r in rows.items() if r.held_out and d in labels]
    assert len(held) > 50 and np.mean([p == q for p, q in held]) > 0.95
    assert np.mean([p for p, q in held if q == 1]) > 0.97


def test_an_id_of_many_rows_is_one_of_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(LineCRF, "fit", lambda self, x, length, row, label: seen.append(len(label)))
    docs = spark.createDataFrame([(i % 8, f"line {i}") for i in range(200)], "doc_id long, text string")
    train(docs, spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int"))
    assert seen == [sum(zlib.crc32(str(d).encode()) % 4 != 2 for d in range(8))]


def test_whole_document_scores_against_all_labellings(spark):
    """Every document of few lines: its score from the sum over all ways to call its lines good or bad."""
    import itertools
    import math

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    assert model.fitted
    checked = 0
    for r in score(docs, model).join(docs, "doc_id").collect():
        x, length, row = line_features(pa.array([r.text]))
        if len(x) > 9:
            continue
        if not len(x):
            assert r.score == 0
            continue
        pad = np.zeros((1, OWN))
        near = np.concatenate((x, np.concatenate((pad, x[:-1])), np.concatenate((x[1:], pad))), axis=1)
        own = np.clip(near @ model.w, -30, 30)
        total, good = 0.0, np.zeros(len(x))
        for states in itertools.product((0, 1), repeat=len(x)):
            e = sum(s / 2 if k else -s / 2 for s, k in zip(own, states, strict=True)) + sum(model.trans[a, b] for a, b in zip(states, states[1:], strict=False))
            total += math.exp(e)
            good += math.exp(e) * np.array(states)
        mean = float((good / total * length).sum() / length.sum())
        assert abs(r.score - 1 / (1 + math.exp(-(model.scale[0] * (mean - 0.5) + model.scale[1])))) < 1e-6
        checked += 1
    assert checked > 50
