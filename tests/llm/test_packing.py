import zlib
from collections import defaultdict

import pytest

from halocline.llm.packing import PlainIds, TierPacker, WordIds, deal_steps, ids_of, op5_packing, pack, tokenizer_file

SF = "/root/testdata/sf0.001"
ODD = ["", None, " ", "a  b", "Don't STOP ÉÀ ß İx Σς", "x\x1cy\ta b", "1234 a1b2 ½ §", "<|endoftext|> <|x", "ño ́a", "..,, word,.: |a|", "w" * 3000, "ab " * 9000, "été\nNaïve\r\nend", "İstanbul ΑΣ. ªº µ"]


def direct(texts, name="word_bpe_49k.json"):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file(name))
    return [[*t.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]


def check(rows, expected):
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    assert set(docs) == set(expected)
    for d, ids in expected.items():
        at = 0
        for r in sorted(docs[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            at += r.length
            raw = b"".join(i.to_bytes(4, "little") for i in ids[r.start : at])
            assert zlib.crc32(raw) == (r.ids_crc32 if hasattr(r, "ids_crc32") else zlib.crc32(bytes(r.ids)))
        assert at == len(ids)
    for s in seqs.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096 and at & (at - 1) == 0 and all(r.tier == at for r in s)


def test_odd_texts(spark):
    df = spark.createDataFrame([(i, x, "s") for i, x in enumerate(ODD)], "doc_id long, text string, tier string").coalesce(1)
    check(pack(df, tokenizer_file(), buffer_tokens=5000).collect(), dict(enumerate(direct(ODD))))


def test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    check(op5_packing(spark, SF).collect(), dict(zip([d.doc_id for d in docs], direct([d.text for d in docs]), strict=True)))


def test_empty(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), tokenizer_file()).count() == 0


@pytest.mark.parametrize("lengths", [[1], [4096], [4097, 511], [3000] * 7, [100] * 200, [2049, 700, 300, 9000, 5]])
def test_packer_keeps_every_token(lengths):
    p = TierPacker()
    out = [s for k, n in enumerate(lengths) for s in p.add(k, n)] + list(p.pack(False)) + list(p.pack(True))
    assert sum(x[2] for s in out for x in s) == sum(lengths)
    assert sum(n & (n - 1) > 0 for n in (sum(x[2] for x in s) for s in out)) == 0
    assert sorted(t for s in out for k, a, n in s for t in ((k, i) for i in range(a, a + n))) == [(k, i) for k, n in enumerate(lengths) for i in range(n)]


def test_steps_are_even():
    lengths = [4096] * 20 + [1024] * 9 + [512] * 3
    groups = deal_steps(lengths, 32768)
    sums = defaultdict(int)
    for n, g in zip(lengths, groups, strict=True):
        sums[g] += n
    assert max(sums.values()) - min(sums.values()) <= 4096


def test_other_vocabularies_are_encoded_whole(spark, tmp_path):
    import json

    other = tokenizer_file("byte_bpe_50k.json")
    assert isinstance(ids_of(tokenizer_file()), WordIds) and isinstance(ids_of(other), PlainIds)
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").coalesce(1)
    check(pack(df, other, buffer_tokens=5000).collect(), dict(enumerate(direct(ODD, "byte_bpe_50k.json"))))
    file = json.load(open(tokenizer_file(), encoding="utf-8"))
    file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = "\\\\S+"
    changed = tmp_path / "changed.json"
    changed.write_text(json.dumps(file), encoding="utf-8")
    assert isinstance(ids_of(str(changed)), PlainIds)
