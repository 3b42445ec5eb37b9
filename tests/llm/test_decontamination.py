import hashlib
import random
import re
import time
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import functions as F

from halocline.llm.decontamination import WINDOW, Index, Words, contaminated_spans, decontaminate, op3_decontamination, winnow

SF = "/root/testdata/sf0.001"


def brute_force(docs: list[tuple], items: list[tuple]) -> dict:
    """The contract word by word: doc_id to (n_words, n_hit, n_items, sha256, contaminated)."""
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(low))
    windows = defaultdict(set)
    for item_id, text in items:
        w = split(text)
        n = min(WINDOW, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows[tuple(w[i : i + n])].add(str(item_id))
    out = {}
    for doc_id, text in docs:
        w = split(text)
        hit, own = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    own |= found
        out[doc_id] = (len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit))
    return out


def as_dict(found):
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s[1] - s[0])
    rows = found.select("doc_id", "n_words", hit.alias("h"), F.size("items").alias("k"), F.sha2(F.array_join("items", ","), 256).alias("s")).collect()
    return {r.doc_id: (r.n_words, r.h, r.k, r.s, r.h > 0) for r in rows}


def fixture():
    rnd = random.Random(7)
    vocab = ["a", "b", "c1", "é", "Dé", "word", "Z"]
    text = lambda n: "".join(rnd.choice(vocab) + rnd.choice([" ", ", ", "\n", "-", "_"]) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([0, 1, 3, 9, 10, 11, 25, 40])] + [(100, None), (101, "..."), (6, "same id again " * 5)]
    docs = [(i, text(rnd.randrange(200))) for i in range(60)] + [(60, None), (61, ""), (62, "...")]
    docs += [(70 + i, text(30) + t.upper() + text(30)) for i, (_, t) in enumerate(items) if t]
    return docs, items


def test_brute_force_one_and_many_blocks(spark):
    docs, items = fixture()
    expected = brute_force(docs, items)
    d = spark.createDataFrame([(*x, "n") for x in docs], "doc_id long, text string, n_words string")
    b = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, spans int")
    assert as_dict(contaminated_spans(d, b)) == expected
    assert as_dict(contaminated_spans(d, b, block_bytes=150)) == expected


def test_long_items_only(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rnd.choices(words, k=60))) for i in range(20)]
    docs = [(i, " ".join(rnd.choices(words, k=300) + items[i % 20][1].split()[5 : 5 + i % 40] + rnd.choices(words, k=30))) for i in range(80)]
    expected = brute_force(docs, items)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert as_dict(contaminated_spans(d, b)) == expected
    assert 0 < sum(x[4] for x in expected.values()) < 80
    kept = {r.doc_id for r in decontaminate(d, b).collect()}
    assert kept == {k for k, x in expected.items() if not x[4]}


def test_repeated_rows_and_empty_tables(spark):
    text = "one two three four five six seven eight nine ten eleven"
    d = spark.createDataFrame([(1, text), (1, text), (2, None)], "doc_id long, text string")
    b = spark.createDataFrame([(5, text)], "item_id long, text string")
    assert sorted((r.doc_id, len(r.items)) for r in contaminated_spans(d, b).collect()) == [(1, 1), (1, 1), (2, 0)]
    assert sorted((r.doc_id, len(r.items)) for r in contaminated_spans(d, b.limit(0)).collect()) == [(1, 0), (1, 0), (2, 0)]
    assert contaminated_spans(d.limit(0), b).count() == 0


def test_table(spark):
    rows = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in op3_decontamination(spark, SF).collect()}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert rows == brute_force(docs, items)


def test_winnowing_selects_few_places_and_one_in_every_window():
    rnd = random.Random(11)
    texts = [" ".join(rnd.choice("abc") for _ in range(n)) for n in (0, 4, 9, 10, 300)] + [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(5000))]
    words = Words(pa.array(texts))
    at, prints = winnow(words, 5, 6)
    assert len(at) == len(set(at.tolist())) and len(at) < 0.45 * len(words)
    chosen = set(at.tolist())
    assert all(any(p in chosen for p in range(i, i + 6)) for i in words.begins(WINDOW).tolist())
    assert len(set(zip((words.row[at] == 5).tolist(), prints.tolist(), strict=True))) > 1000


def test_a_passage_of_many_items_is_looked_up_once():
    passage = " ".join(f"licence{k}" for k in range(40))
    items = [(str(i), f"own{i} {passage} end{i}") for i in range(500)]
    index = Index(items, WINDOW)
    assert len(index.at) < 0.5 * len(winnow(index.words, 5, 6)[0]) and len(index.lists) == 500 + 1
    place, cls = index.shared(Words(pa.array([f"x {passage} y", "nothing of it"])))
    assert place.tolist() == list(range(1, 32)) and {len(index.lists[index.class_list[c]]) for c in cls.tolist()} == {500}


def test_words_of_equal_hash_do_not_count(monkeypatch):
    monkeypatch.setattr("halocline.llm.decontamination.word_hashes", lambda data, start, end: (end - start).astype("uint64"))
    items = [("1", "aa bbb c dd eee f gg hhh i jj kkk"), ("2", "ab bbc d de eef g gh hhi j jk kkl")]
    index = Index(items, WINDOW)
    words = Words(pa.array(["zz aa bbb c dd eee f gg hhh i jj q", "xx yyy z xx yyy z xx yyy z xx yyy"]))
    place, cls = index.shared(words)
    assert place.tolist() == [1] and index.lists[index.class_list[cls[0]]] == ("1",)


def test_work_does_not_grow_with_the_items_that_share_a_passage():
    """3,000 items with one opening of ten words, and a document that repeats it for 80 KB."""
    opening = "answer the following question with one of the choices below"
    items = [(str(i), f"{opening} own{i} words{i} of{i} item{i}") for i in range(3000)]
    index = Index(items, WINDOW)
    words = Words(pa.array([(opening + " ") * 1400]))
    began = time.perf_counter()
    place, cls = index.shared(words)
    assert time.perf_counter() - began < 0.2
    assert place.tolist() == list(range(0, 14_000, 10)) and {len(index.lists[index.class_list[c]]) for c in cls.tolist()} == {3000}
