import hashlib
import os
import random
import re

from pyspark.sql import functions as F

from halocline.llm.common import shared_dir
from halocline.llm.secret_scan import BASE, RULES, BlobLedger, Rule, op1_secret_scan

SF = "/root/testdata/sf0.001"
KINDS = ["assign", "access", "hex", "header", "bearer"]
NAMES = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in n) for n in ("password", "passwd", "secret", "token", "api_?key"))
BEARER = "".join(f"[{c}{c.upper()}]" for c in "bearer")


def plain(text):
    """(counts of the base kinds, sha256, all spans) by the contract."""
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in re.finditer(rf"({NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    more = [(m.start(), 3, m.end()) for m in re.finditer(r"-----BEGIN [A-Z ]*PRIVATE KEY-----", text)]
    more += [(m.start(), 4, m.end()) for m in re.finditer(rf"{BEARER}\x20+[A-Za-z0-9._~+/=-]+", text) if len(m[0]) >= 24]
    show = lambda x: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(x))
    return (*[sum(k == j for _, k, _ in spans) for j in range(3)], hashlib.sha256(show(spans).encode()).hexdigest(), show(spans + more))


def texts():
    rnd = random.Random(1)
    bits = ["token", "TOKEN", "toKen", "api_key", "APIKEY", "passwd", "password", " ", "  ", "=", ":", "==", "'", '"', "abc", "abcdef", "é", "AKIA", "AKIAAKIA", "A1B2C3D4E5F6G7H8", "0123456789abcdef", "ff", "\x01", "\x02", "\n", "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN " + "LONG " * 20 + "PRIVATE KEY-----", "Bearer abcdefghijklmnopqrstu", "😀", "ſecret", "toKen", "$1", "\\"]
    return [None, "", " "] + ["".join(rnd.choices(bits, k=rnd.randrange(60))) for _ in range(200)] + ["token=token:abcdefgh", "x" * 100000 + " secret = abcdefg " + "0" * 50000, "token=abcdef " * 5000]


def rows_of(found):
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")
    return {r.doc_id: r.s for r in found.select("doc_id", joined(F.col("findings")).alias("s")).collect()}


def test_against_plain_regex(spark, tmp_path):
    rows = list(enumerate(texts()))
    spark.createDataFrame([(*r, "x") for r in rows] + [(1000 + i, t, "x") for i, t in rows[:50]], "doc_id long, text string, blob string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in op1_secret_scan(spark, str(tmp_path)).collect()}
    assert got == {i: plain(t) for i, t in rows} | {1000 + i: plain(t) for i, t in rows[:50]}


def test_only_unseen_pairs_are_scanned(spark):
    df = spark.createDataFrame([(1, "token = abcdef"), (2, "token = abcdef"), (3, None), (None, "AKIA" + "A" * 16)], "doc_id long, text string")
    ledger = BlobLedger(spark, shared_dir(spark), BASE)
    assert rows_of(ledger.scan(df)) == {1: "assign:0:14", 2: "assign:0:14", 3: "", None: "access:0:20"}
    assert spark.read.parquet(ledger.parts[0]).count() == 3
    more = df.unionByName(spark.createDataFrame([(4, "secret:qwertyu")], df.schema))
    assert rows_of(ledger.scan(more))[4] == "assign:0:14"
    assert spark.read.parquet(ledger.parts[1]).count() == 1
    newer = Rule("access", BASE[1].pattern, 4, version=2)
    ledger.rules = (BASE[0], newer, BASE[2])
    assert rows_of(ledger.scan(more)) == {1: "assign:0:14", 2: "assign:0:14", 3: "", 4: "assign:0:14", None: "access:0:20"}
    third = spark.read.parquet(ledger.parts[2])
    assert third.count() == 4 and all(r.scanned == ["access:2"] for r in third.collect())


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert BlobLedger(spark, shared_dir(spark), RULES).scan(df).count() == 0


def test_table(spark):
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in op1_secret_scan(spark, SF).collect()}
    assert got == {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_ledger_is_opened_again_and_a_scan_is_done_again(spark):
    df = spark.createDataFrame([(1, "token = abcdef"), (2, "secret:qwertyu")], "doc_id long, text string")
    path = shared_dir(spark)
    BlobLedger(spark, path, BASE).scan(df.where("doc_id = 1"))
    os.makedirs(f"{path.removeprefix('file:')}/scan-00001")  # a scan that died before its end
    again = BlobLedger(spark, path, BASE)
    assert rows_of(again.scan(df)) == {1: "assign:0:14", 2: "assign:0:14"}
    assert [spark.read.parquet(p).count() for p in again.parts] == [1, 1]
    assert rows_of(BlobLedger(spark, path, BASE).scan(df)) == {1: "assign:0:14", 2: "assign:0:14"}
    assert [spark.read.parquet(p).count() for p in again.parts] == [1, 1, 0]


def test_scans_at_one_time_keep_both_parts(spark):
    """Two scans that began before either had ended: no part is lost, and what both found counts once."""
    df = spark.createDataFrame([(1, "token = abcdef"), (2, "secret:qwertyu")], "doc_id long, text string")
    path = shared_dir(spark)
    first, second = BlobLedger(spark, path, BASE), BlobLedger(spark, path, BASE)
    first.scan(df)
    inside = second.__class__.read
    try:
        second.__class__.read = lambda self: None if not self.parts[1:] else inside(self)  # as it looked at the start
        second.scan(df)
    finally:
        second.__class__.read = inside
    assert [spark.read.parquet(p).count() for p in first.parts] == [2, 2]
    assert rows_of(first.scan(df)) == {1: "assign:0:14", 2: "assign:0:14"}


def test_header_of_any_length():
    assert plain("-----BEGIN " + "A " * 500 + "PRIVATE KEY-----")[4] == "header:0:1027"
