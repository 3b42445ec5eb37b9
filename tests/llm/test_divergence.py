import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from halocline.llm.divergence import divergence, host_of, pack_vector, rounds_of, share, unpack_vector

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_force(docs, least, top):
    found, in_docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in docs:
        g = (lang or "", source or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))
        groups.add(g)
        found[g].update(terms)
        in_docs[g[0]].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted((t for t, n in in_docs[lang].items() if n >= least), key=str.encode)
        own = sorted(g for g in groups if g[0] == lang)
        counts = {g: [found[g][t] for t in kept] for g in own}
        counts[None] = [sum(counts[g][k] for g in own) for k in range(len(kept))]
        p = {g: [1 + 10**9 * (c + 5) // (sum(cs) + 5 * len(kept)) for c in cs] for g, cs in counts.items()}
        for g in own:
            pairs = [(-sum(abs(a - b) for a, b in zip(p[g], p[h], strict=True)), h[1].encode(), h[1]) for h in own if h != g]
            terms = [(b - a, t.encode(), t) for t, c, a, b in zip(kept, counts[g], p[g], p[None], strict=True) if c and a > b]
            out += [(*g, "pair", item, -v, k) for k, (v, _, item) in enumerate(sorted(pairs), 1)]
            out += [(*g, "term", item, -v, k) for k, (v, _, item) in enumerate(sorted(terms)[:top], 1)]
    return sorted(out)


def fixture():
    rnd = random.Random(5)
    vocab = ["alpha", "Beta", "é", "日本", "zz", "Zz", "a_b", "x1y", "-", "ñu", *(f"w{chr(97 + k)}" for k in range(20))]
    docs = []
    for k in range(400):
        source = "hot" if k % 3 == 0 else f"s{rnd.randrange(11)}"
        docs.append((rnd.choice(["en", "de"]), source, " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(30)))))
    return docs + [("en", "silent", "7 8 9"), ("en", None, None), (None, "only", "few"), ("en", "again", "zz zz zz"), ("en", "again", "zz zz zz"), ("fr", "a", "un"), ("fr", "b", "deux")]


SETTINGS = [{}, {"block": 4, "least_seats": 3}, {"block": 7, "least_seats": 4, "wave": 1}, {"least_seats": 100, "wave": 2}, {"seat_bytes": 40, "least_seats": 1, "wave": 3}]


@pytest.mark.parametrize("settings", SETTINGS)
def test_brute_force(spark, settings):
    docs = fixture()
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "lang string, source string, text string, rank int, term string").repartition(5)
    got = sorted(tuple(r) for r in divergence(df, least_docs=5, top=6, **settings).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == brute_force(docs, 5, 6)


def test_no_kept_terms_and_empty_table(spark):
    docs = fixture()[:20]
    df = spark.createDataFrame(docs, "lang string, source string, text string")
    assert sorted(tuple(r) for r in divergence(df, least_docs=1000).collect()) == brute_force(docs, 1000, 50)
    assert divergence(df.limit(0)).collect() == []


@pytest.mark.parametrize("seats", range(1, 18))
def test_all_seats_meet_once(seats):
    met = Counter()
    for r in range(1, rounds_of(seats) + 1):
        callers = [(s, h) for s in range(seats) if (h := host_of(s, r, seats)) is not None]
        busy = [x for pair in callers for x in pair]
        assert len(busy) == len(set(busy))  # nobody is in two meetings of a round
        met.update(frozenset(c) for c in callers)
    assert len(met) == seats * (seats - 1) // 2 and set(met.values()) <= {1}


def test_shares_are_exact():
    rnd = random.Random(1)
    for _ in range(2000):
        total, v = rnd.randrange(10**13), rnd.randrange(1, 10**6)
        n = rnd.randrange(total + 1)
        assert int(share(n, total, v)) == 1 + 10**9 * (n + 5) // (total + 5 * v)


def test_vectors_round_trip():
    ids, n = np.array([3, 9, 8191]), np.array([1, 10**12, 7])
    assert [x.tolist() for x in unpack_vector(pack_vector(ids, n))] == [ids.tolist(), n.tolist()]
