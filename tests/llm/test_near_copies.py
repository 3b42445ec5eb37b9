import random

import corpus_pipeline
from halocline.llm.near_copies import keep_one

SCHEMA = "doc_id long, text string, tag string"


def plain_set(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def similar(a, b):
    a, b = plain_set(a), plain_set(b)
    return 5 * len(a & b) >= 4 * len(a | b)


def copies(rnd, n, changes):
    words = [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    other = list(words)
    for k in rnd.sample(range(n), changes):
        other[k] = f"x{rnd.randrange(10**6)}"
    return " ".join(words), " ".join(other)


def test_stage_finds_copies_beyond_two_bits(spark):
    rnd = random.Random(1)
    rows = []
    for k in range(60):
        a, b = copies(rnd, 300, (1, 3, 5, 6, 12, 25)[k % 6])
        rows += [(2 * k, a, "a"), (2 * k + 1, b, "b")]
    texts = {d: t for d, t, _ in rows}
    kept = {r.doc_id for r in corpus_pipeline.keep_near(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert kept == {d for d in texts if d % 2 == 0 or not similar(texts[d], texts[d - 1])}
    assert 60 < len(kept) < 120


def test_large_groups(spark, monkeypatch):
    """Rounds of pivots and all pairs at once keep no two rows that link."""
    rnd = random.Random(2)
    words = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(150):
        own = list(words)
        for at in rnd.sample(range(120), 1 + k % 4):
            own[at] = f"y{k}"
        rows.append((k, " ".join(own), ""))
    df = spark.createDataFrame(rows, SCHEMA)
    for limits, size in (({}, 150), ({"MEET": 4, "PAIRS_A_TASK": 3, "CLOSEST": 2}, 40), ({"CROWD": 3}, 25)):
        for name, limit in limits.items():
            monkeypatch.setattr(f"halocline.llm.near_copies.{name}", limit)
        kept = [r.text for r in keep_one(df.where(f"doc_id < {size}")).collect()]
        assert 0 < len(kept) < size and not any(similar(a, b) for k, a in enumerate(kept) for b in kept[:k])


def test_rows_of_one_id_repeated_rows_and_null_ids(spark):
    a, b = copies(random.Random(3), 200, 1)
    rows = [(1, a, "x"), (2, b, "x"), (2, "a text of its own, which stays", "x"), (3, "again", "x"), (3, "again", "x"), (3, "again", "y"), (None, "again", "x"), (None, "no id has this", "x"), (None, "no id has this", "x"), (4, None, "x"), (5, " ", "x")]
    kept = keep_one(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "tag"]
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted([(1, a), (2, "a text of its own, which stays"), (3, "again"), (0, "no id has this"), (4, "")])
    assert keep_one(kept.limit(0)).count() == 0


def test_differences_to_a_hub_tell_all_links():
    import numpy as np

    from halocline.llm.near_copies import differing, shingle_set

    rnd = random.Random(7)
    words = [f"w{k}" for k in range(150)]
    texts = [" ".join(words)]
    for k in range(60):
        own = list(words)
        for at in rnd.sample(range(150), 1 + k % 6):
            own[at] = f"z{k % 9}"
        texts.append(" ".join(own))
    sets = [shingle_set(t) for t in texts]
    differ = [np.setxor1d(sets[0], s) for s in sets]
    at = np.concatenate(([0], np.cumsum([len(d) for d in differ])))
    n, every = np.array([len(s) for s in sets]), np.ones(len(sets), bool)
    a, b = differing(slice(0, len(sets)), at, np.concatenate(differ).view(np.int64), n, np.arange(len(sets)), every, every)
    expected = {(i, j) for i, x in enumerate(texts) for j, y in enumerate(texts) if i != j and similar(x, y)}
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == expected and 100 < len(expected) < 60 * 61
    # one link for each other group is enough
    a, b = differing(slice(0, len(sets)), at, np.concatenate(differ).view(np.int64), n, np.arange(len(sets)) // 30, every, every)
    assert all(i // 30 != j // 30 for i, j in zip(a, b, strict=True)) and len(set(zip(a.tolist(), (b // 30).tolist(), strict=True))) == len(a)


def test_a_crowded_band_loses_no_link(spark, monkeypatch):
    """All texts share their only key and a passage, so no second key can find what links in their band."""
    import numpy as np

    monkeypatch.setattr("halocline.llm.near_copies.bands", lambda least: np.array([7], np.uint64))
    rnd = random.Random(9)
    passage = " ".join(f"p{k}" for k in range(40))
    rows = []
    for k in range(30):
        a, b = copies(rnd, 200, (3, 4, 5, 6, 12)[k % 5])
        rows += [(2 * k, f"{passage} {a}", "a"), (2 * k + 1, f"{passage} {b}", "b")]
    rows += [(60, passage, ""), (61, passage + " one more", ""), (62, "a b", ""), (63, "a b c", "")]
    texts = {d: t for d, t, _ in rows}
    linked = {d for d in texts if d % 2 and similar(texts[d], texts[d - 1])}
    assert 10 < len(linked) < 31
    df = spark.createDataFrame(rows, SCHEMA)
    for name, limit in {"CROWD": 3, "MEET": 4, "ASK": 3}.items():
        monkeypatch.setattr(f"halocline.llm.near_copies.{name}", limit)
    assert {r.doc_id for r in keep_one(df).collect()} == set(texts) - linked


def test_who_asks_meets_each_member_once(spark):
    from pyspark.sql import functions as F

    from halocline.llm import near_copies

    ends = "struct<first_: long, key_: long>"
    rows = spark.range(50).select(F.lit(1).cast("long").alias("band"), F.struct(F.col("id").alias("first_"), F.col("id").alias("key_")).cast(ends).alias("node_"), F.struct(F.col("id").alias("first_"), F.col("id").alias("key_")).cast(ends).alias("root"))
    bands_ = spark.range(1).select(F.lit(1).cast("long").alias("band"), F.lit(50).cast("long").alias("size"), F.lit(17).cast("long").alias("askers"))
    old = near_copies.MEET, near_copies.ASK
    near_copies.MEET, near_copies.ASK = 7, 5
    try:
        got = near_copies.pieces_of(rows, bands_, F.col("node_.first_") % 3 == 0).collect()
    finally:
        near_copies.MEET, near_copies.ASK = old
    pieces = {}
    for r in got:
        pieces.setdefault(r.piece, []).append(r)
    pairs = [(a.node_.first_, b.node_.first_) for piece in pieces.values() for a in piece if a.asks for b in piece if b.member]
    assert sorted(pairs) == [(a, b) for a in range(0, 50, 3) for b in range(50)]
    assert max(sum(r.asks for r in piece) for piece in pieces.values()) < 17
