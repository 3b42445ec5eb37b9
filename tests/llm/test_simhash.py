import random
import re

import numpy as np
import pytest
import xxhash

from halocline.llm.simhash import BKTree, components, fingerprint, forest, keep_one, links, near_duplicates, op8_simhash

SF = "/root/testdata/sf0.001"
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def group(fps, radius=2):
    """Component (least member) of every fingerprint, from all pairs."""
    fps = sorted(set(fps))
    up = {f: f for f in fps}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {f: top(f) for f in fps}


def clouds(seed, centres, n):
    rnd = random.Random(seed)
    out = set()
    for _ in range(centres):
        c = rnd.getrandbits(64)
        for _ in range(n):
            x = c
            for _ in range(rnd.randrange(6)):
                x ^= 1 << rnd.randrange(64)
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("text", [None, "", " \t", "One", "two words", "A b\x0bC d e", "É é\xa0x\x85y \x1cz \x00 w", "word " * 70000])
def test_fingerprint(text):
    assert fingerprint(text) == plain(text)


def test_forest_joins_what_links_join():
    fps = clouds(1, 5, 60)
    a, b = forest(np.array(fps, np.uint64), 2)
    expected = group(fps)
    assert len(a) == len(fps) - len(set(expected.values()))
    up = {f: f for f in fps}
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        assert expected[x] == expected[y]
        up[x] = y
    assert len({y for x, y in up.items() if x == y}) == len(set(expected.values()))
    tree = BKTree(np.array(fps, np.uint64))
    pairs = {(n, int(q)) for n, near in tree.within(2) for q in near}
    assert pairs == {(i, j) for i, x in enumerate(fps) for j, y in enumerate(fps) if 0 < (x ^ y).bit_count() <= 2}


@pytest.mark.parametrize("limit", [2000, 3])
def test_links_and_components(spark, limit):
    fps = clouds(2, 8, 40) + [0, 1, 3, 2**63, 2**64 - 1]
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    found = components(links(spark.createDataFrame([(f,) for f in signed], "fp long").distinct(), 2, limit)).collect()
    expected = group(fps)
    mine = {int(np.int64(r.node).view(np.uint64)): r.root for r in found}
    assert len(mine) == len(found)
    classes, theirs = {}, {}
    for f in set(fps):
        classes.setdefault(mine.get(f, int(np.uint64(f).view(np.int64))), set()).add(f)
        theirs.setdefault(expected[f], set()).add(f)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, theirs.values()))


def test_long_chain(spark):
    n = 300
    ids = random.Random(5).sample(range(10**6), n)
    edges = spark.createDataFrame(list(zip(ids, ids[1:], strict=False)), "a long, b long")
    rows = components(edges).collect()
    assert len(rows) == n and {r.root for r in rows} == {min(ids)}
    assert components(edges.limit(0)).count() == 0


def test_table_and_odd_rows(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in rows] + [(10**6, None), (10**6, ""), (10**6 + 1, "  "), (None, "lonely text of no id"), (10**6 + 2, "lonely text of no id")]
    found = near_duplicates(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, fp int")).collect()
    fps = {r[0]: plain(r[1]) for r in rows}
    part = group(fps.values())
    least = {}
    for d, f in fps.items():
        if d is not None:
            least[part[f]] = min(d, least.get(part[f], d))
    assert len(found) == len(rows)
    for r in found:
        assert int(np.int64(r.fp).view(np.uint64)) == fps[r.doc_id] and r.component_id == least[part[fps[r.doc_id]]]
    kept = keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in kept} - {None} == set(least.values())


def test_query(spark):
    rows = op8_simhash(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id: r.fingerprint for r in rows} == {d: f"{plain(t):016x}" for d, t in texts.items()}
