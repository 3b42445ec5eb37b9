import os
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from halocline.llm.common import shared_dir
from halocline.llm.exact_dedup import DigestIndex, exact_groups, keep_one, op6_exact_dedup, sha256

SF = "/root/testdata/sf0.001"
ROWS = [(1, "a"), (2, "a"), (3, ""), (4, None), (5, "b"), (5, "b"), (6, "é" * 9000), (7, "é" * 9000), (8, "a "), (None, "c"), (9, "c"), (None, "alone")]


def plain(rows, keep=max):
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    out = []
    for d, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        best = keep(ids) if ids else None
        out.append((d, best, len(groups[t or ""]), d == best))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("keep", ["max", "min"])
def test_groups(spark, keep):
    df = spark.createDataFrame([(*r, 1, "x") for r in ROWS], "doc_id long, text string, n int, best string")
    assert got(exact_groups(df, keep)) == plain(ROWS, {"max": max, "min": min}[keep])


def test_weak_digest_is_verified(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert got(exact_groups(df, digest=lambda t: F.substring(sha256(t), 1, 0))) == plain(ROWS)


def test_full_filter(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert got(exact_groups(df, filter_bits=64)) == plain(ROWS)


def test_runs_and_compaction(spark):
    index = DigestIndex(spark, shared_dir(spark), "min", memtable_rows=2)
    df = spark.createDataFrame(ROWS, "doc_id long, text string").select("doc_id", sha256(F.coalesce("text", F.lit(""))).alias("digest"))
    index.flush(df.where("doc_id < 5"))
    index.flush(df.where("doc_id >= 5 or doc_id is null"))
    assert len(index.runs) == 2
    rows = index.compact().collect()
    assert len(index.runs) == 1 and os.path.isdir(index.runs[0].removeprefix("file:"))
    assert sorted((r.best or -1, r.n) for r in rows) == sorted([(1, 2), (3, 2), (5, 2), (6, 2), (8, 1), (9, 2), (-1, 1)])


def test_keep_one_and_empty(spark):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(ROWS)], "doc_id long, text string, n int")
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, -1, 2, 4, 5, 5, 7, 8, 9]
    assert exact_groups(df.limit(0)).count() == 0


def test_keep_one_with_an_id_of_several_texts(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "b", 0), (2, "a", 0), (2, None, 0)], "doc_id int, text string, digest int")
    assert sorted((r.doc_id, r.text) for r in keep_one(df).where("text is not null").collect()) == [(1, "b"), (2, "a")]
    assert keep_one(df).count() == 3


def test_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(op6_exact_dedup(spark, SF)) == plain(rows)


def test_stage_keeps_one_row_of_each_text(spark):
    import corpus_pipeline

    df = spark.createDataFrame([(*r, i) for i, r in enumerate([*ROWS, (None, "alone"), (2, "a")])], "doc_id long, text string, n int")
    kept = corpus_pipeline.keep_exact(spark, df, "")
    assert kept.columns == df.columns
    rows = [(r.doc_id or -1, r.text or "") for r in kept.collect()]
    assert sorted(rows) == [(-1, "alone"), (2, "a"), (4, ""), (5, "b"), (7, "é" * 9000), (8, "a "), (9, "c")]


def test_index_is_opened_again_and_compacted_by_tiers(spark, monkeypatch):
    import random

    rnd = random.Random(6)
    path = shared_dir(spark)
    flushed = [[(rnd.randrange(1000), f"t{rnd.randrange(60)}") for _ in range(40)] for _ in range(9)]
    digests = lambda rows: spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", sha256(F.col("text")).alias("digest"))
    for k, rows in enumerate(flushed):
        index = DigestIndex(spark, path, filter_bits=4096)  # a new process each time
        index.flush(digests(rows))
        while index.compact_tier():
            pass
        assert len(index.spans()) == [1, 2, 3, 1, 2, 3, 4, 2, 3][k]
    expected = defaultdict(list)
    for d, t in sum(flushed, []):
        expected[t].append(d)
    os.makedirs(f"{index.path.removeprefix('file:')}/runs/00009-00009-0")  # a flush that died
    asked = spark.createDataFrame([(f"t{k}",) for k in range(80)], "text string").select("text", sha256(F.col("text")).alias("digest"))
    index = DigestIndex(spark, path, filter_bits=4096)
    found = index.lookup(asked.select("digest")).join(asked, "digest").collect()
    assert {r.text: (r.best, r.n) for r in found} == {t: (max(d), len(d)) for t, d in expected.items()}
    index.flush(digests([(5000, "t0")]))
    assert index.spans()[-1] == (9, 9, 0)
    assert {r.text: r.best for r in index.lookup(asked.select("digest")).join(asked, "digest").collect()}["t0"] == 5000
    assert {r.n for r in index.compact().join(asked.where("text = 't0'"), "digest").collect()} == {len(expected["t0"]) + 1}
    assert DigestIndex(spark, shared_dir(spark)).lookup(asked).count() == 0


def test_ingest_goes_through_runs_filters_and_lookups(spark):
    index = DigestIndex(spark, shared_dir(spark))
    rows = [(i, f"t{i % 70}") for i in range(100)] + [(None, "t1"), (None, "only")]
    digests = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", sha256(F.col("text")).alias("digest"))
    hits = index.ingest(digests.drop("text"), 6)
    again = {r.text for r in hits.join(digests.select("digest", "text").distinct(), "digest").collect()}
    assert again == {f"t{i}" for i in range(30)}
    assert index.spans() == [(0, 3, 1), (4, 4, 0), (5, 5, 0)]
    assert sorted(os.listdir(f"{index.path.removeprefix('file:')}/filters"))[1:] == ["00004-00004-0", "00005-00005-0"]
    plan = index.lookup(hits)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 3 and plan.count("scalar-subquery") >= 9
    assert {r.n for r in index.lookup(hits).join(digests.where("text = 't1'").select("digest").distinct(), "digest").collect()} == {3}


def test_groups_come_from_a_compacted_index(spark):
    rows = [(i, f"t{i % 70}") for i in range(100)]
    path = shared_dir(spark)
    assert got(exact_groups(spark.createDataFrame(rows, "doc_id long, text string"), path=path)) == plain(rows)
    assert DigestIndex(spark, path).spans() == [(0, 3, 1), (4, 4, 0)]
