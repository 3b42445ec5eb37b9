import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from halocline.llm.common import read_table
from halocline.llm.resampling import Advance, Trie, draw, numbered, op12_resampling, resample

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def features_of(text):
    w = words_of(text)
    return w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def brute_force(docs, target, buckets=10_000, percent=25, least=20):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(bucket(f, buckets) for f in features_of(text))
    for _, text in target:
        t.update(bucket(f, buckets) for f in features_of(text))
    all_s, all_t = float(s.total()), float(t.total())
    gain = [math.floor(1000 * math.log((float(t[b]) + 1) * (all_s + buckets) / ((float(s[b]) + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        f = features_of(text)
        weight = sum(gain[bucket(x, buckets)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(words_of(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0]))
    drawn = len(able) * percent // 100
    return Counter((*r, k if k <= drawn else None) for k, r in enumerate(able, 1)) + Counter((*r, None) for r in rows if r[1] < least)


def as_rows(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect())


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40), st.binary(max_size=70))
def test_states_move_over_following_bytes(a, b):
    moved = Advance()(np.array([zlib.crc32(a)], np.uint32), np.array([len(b)]))
    assert int(moved[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB1é 日.-\n", max_size=30), st.just("x" * 90 + " " + "y" * 70)), max_size=6))
def test_trie_counts_every_path(texts):
    trie, totals = Trie(pa.array(texts, pa.string()), Advance()), np.zeros(97, np.int64)
    trie.add_to(totals)
    found = [features_of(t) for t in texts]
    assert Counter(bucket(f, 97) for fs in found for f in fs) == Counter({k: int(n) for k, n in enumerate(totals) if n})
    words, features = trie.features()
    assert words.tolist() == [len(words_of(t)) for t in texts] and features.tolist() == [len(f) for f in found]
    gains = np.arange(97) - 50
    assert trie.gained(gains).tolist() == [sum(int(gains[bucket(f, 97)]) for f in fs) for fs in found]


def fixture():
    rnd = random.Random(11)
    vocab = ["the", "A", "cat", "é", "x" * 80, "7", "Ünd", "zz"]
    text = lambda n: "".join(rnd.choice(vocab) + rnd.choice([" ", ", ", "\n", "_"]) for _ in range(n))
    docs = [(i, text(rnd.randrange(60))) for i in range(80)]
    docs += [(200, None), (201, ""), (202, "..."), (None, text(30)), (3, text(25)), (7, "same words " * 15), (7, "same words " * 15), (300, text(3000))]
    return docs, [(i, text(12)) for i in range(10)] + [(50, None)]


@pytest.fixture
def many_tasks(spark):
    """Small inputs stay in as many tasks as large ones would."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_brute_force(spark, many_tasks):
    docs, target = fixture()
    d = spark.createDataFrame([(*x, "c") for x in docs], "doc_id long, text string, score string").repartition(6)
    t = spark.createDataFrame(target, "item_id long, text string")
    assert as_rows(resample(d, t)) == brute_force(docs, target)
    assert as_rows(resample(d, t, buckets=13, percent=60, least_words=5)) == brute_force(docs, target, 13, 60, 5)
    assert as_rows(resample(d, t.limit(0))) == brute_force(docs, [])
    assert resample(d.limit(0), t).count() == 0
    kept = draw(d, t)
    assert kept.columns == d.columns and 0 < kept.count() < len(docs)


def test_numbering_over_many_tasks(spark, many_tasks):
    rows = [(i * 37 % 101, i) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(7)
    got = numbered(df, [df.k.desc(), df.v.asc()], "place").orderBy("place").collect()
    assert [(r.k, r.v) for r in got] == sorted(rows, key=lambda r: (-r[0], r[1]))
    assert [r.place for r in got] == list(range(1, 501))


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in read_table(spark, sf, "documents").select("doc_id", "text").collect()]
    target = [tuple(r) for r in read_table(spark, sf, "benchmark").select("item_id", "text").collect()]
    assert as_rows(op12_resampling(spark, sf)) == brute_force(docs, target)
