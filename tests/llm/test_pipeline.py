from collections import defaultdict

import corpus_pipeline
from halocline.llm.common import materialize
from halocline.llm.quality import score, train
from tests.llm.test_decontamination import brute_force
from tests.llm.test_near_copies import plain_set
from tests.llm.test_packing import direct

SF = "/root/testdata/sf0.001"


def least_of_groups(texts):
    """The smallest id of each group that links of similarity 0.8 or more join, from all pairs."""
    sets = {d: plain_set(t) for d, t in texts.items()}
    up = {d: d for d in sets}

    def top(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {top(d) for d in ids}


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r.doc_id: r.text for r in docs.collect()}
    outs = []
    df = docs
    for _, stage in corpus_pipeline.STAGES:
        df = materialize(stage(spark, df, SF))
        outs.append(df)
    assert all(o.columns == docs.columns for o in outs[:-1])

    good = {r.doc_id for r in score(docs, train(docs, labels)).where("score >= 0.7").collect()}
    kept = {d: t for d, t in kept.items() if d in good}
    assert 0 < len(kept) < docs.count() and {r.doc_id for r in outs[0].collect()} == set(kept)

    best = {}
    for d, t in kept.items():
        best[t] = max(d, best.get(t, d))
    kept = {d: t for t, d in best.items()}
    assert {r.doc_id for r in outs[1].collect()} == set(kept)

    kept = {d: kept[d] for d in least_of_groups(kept)}
    assert {r.doc_id for r in outs[2].collect()} == set(kept)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {d: t for d, t in kept.items() if not brute_force([(d, t)], items)[d][4]}
    assert {r.doc_id for r in outs[3].collect()} == set(kept)

    ids = dict(zip(kept, direct(list(kept.values())), strict=True))
    pieces = defaultdict(list)
    for r in outs[4].collect():
        pieces[r.doc_id].append((r.start, bytes(r.ids)))
    assert {d: b"".join(x for _, x in sorted(p)) for d, p in pieces.items()} == {d: b"".join(i.to_bytes(4, "little") for i in x) for d, x in ids.items()}


def test_odd_rows(spark, tmp_path):
    rows = [(1, None, "en", "a", 0), (1, "", "en", "a", 0), (None, "some words here.\nand more words.", None, None, None), (2, "x " * 50000, "en", "a", 1), (3, "some words here.\nand more words.", "en", "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0  # nothing is known of quality: all score 0.5
    for _, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, df, str(tmp_path)).count() >= 3
        assert stage(spark, df.limit(0), str(tmp_path)).count() == 0
