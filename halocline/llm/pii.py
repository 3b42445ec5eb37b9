"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust their score.

Base kinds are email, ip, card (Luhn) and phone; added kinds are iban (mod-97) and ssn, which needs one context word.
Every confirmed span has a score from its kind, its checksum and the words within CONTEXT_CHARS before and after it, of
the languages of the corpus; base spans are always kept, added spans from ADDED_SCORE on.

Spans are code points, end exclusive; each base kind's matches are leftmost and non-overlapping, and a match that fails
its test is dropped, its text not tried again.  An iban has its country's length, single spaces left out, and ends a
word; one that fails is tried from later words.  Patterns use possessive repeats and look-behinds that do not change
what they match, so that long runs of digits or letters take linear time.

Edge cases: null is empty; repeated rows and null ids give a row each; further columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from halocline.llm.common import read_table, small_batches

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
CONTEXT_CHARS = 40
ADDED_SCORE = 0.6

# The patterns of the queries' contract, and words that speak for or against a kind.
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
NOT_EMAIL_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=[ ]?[A-Z0-9])")
CAPITALS_DIGITS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
LETTERS_DIGITS = CAPITALS_DIGITS | frozenset("abcdefghijklmnopqrstuvwxyz")
#: Characters of each country's numbers.
IBAN_LENGTH = {
    x[:2]: int(x[2:])
    for x in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 "
        "GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 "
        "MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 "
        "TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
    ).split()
}
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
FOR = {
    "email": "mail email contact write reach kontakt schreiben contacto correo escribir courriel contacter",
    "ip": "ip address host server login adresse rechner servidor dirección serveur hôte",
    "card": "card visa mastercard credit payment debit karte kreditkarte zahlung tarjeta crédito pago carte crédit paiement",
    "phone": "call phone tel mobile fax anruf telefon handy mobil llamar teléfono móvil appeler téléphone portable",
    "iban": "iban bank account transfer konto überweisung banco cuenta transferencia banque compte virement",
    "ssn": "ssn social security tax sozialversicherung steuer seguridad impuesto sécurité impôt",
}
AGAINST = {
    "email": "example beispiel ejemplo exemple",
    "ip": "version release versión",
    "card": "order isbn invoice bestellung rechnung pedido factura commande facture",
    "phone": "fraction bruch fracción",
    "iban": "example beispiel ejemplo exemple",
    "ssn": "part serial teil serie pieza pièce série",
}
FOR, AGAINST = ({kind: frozenset(words.split()) for kind, words in table.items()} for table in (FOR, AGAINST))
START = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    """Every second digit from the right counts double, its digits summed; the total ends in 0."""
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(text: str) -> bool:
    """The first four characters go to the end, letters count from A = 10; the remainder by 97 is 1."""
    text = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in text)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of a local part, ``@`` and a domain of two labels or more, found from each ``@``."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and not NOT_EMAIL_LOCAL.match(text, start - 1):
            start -= 1
        found = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)
            done = max(done, start)  # a run before this @ cannot reach across it


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: as many capitals and digits as the country's numbers have, single spaces between them."""
    done = 0
    for m in IBAN_HEAD.finditer(text):
        length = IBAN_LENGTH.get(text[m.start() : m.start() + 2])
        if m.start() < done or not length:
            continue
        at, found = m.end(), m[0]
        while len(found) < length:
            at += text[at : at + 1] == " "
            if not (c := text[at : at + 1]) or c not in CAPITALS_DIGITS:
                break
            found += c
            at += 1
        if len(found) == length and text[at : at + 1] not in LETTERS_DIGITS and mod97(found):
            yield m.start(), at
            done = at


def digits_of(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def proposals(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, kind's place, end) of every confirmed span."""
    if "@" in text:
        for a, b in emails(text):
            yield a, 0, b
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            yield m.start(), 1, m.end()
    for m in CARD.finditer(text):
        if 12 <= m.end() - m.start() and 12 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            yield m.start(), 2, m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m[0])) <= 15:
                yield m.start(), 3, m.end()
    for a, b in ibans(text):
        yield a, 4, b
    if "-" in text:
        for m in SSN.finditer(text):
            if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
                yield m.start(), 5, m.end()


def score_of(text: str, start: int, stop: int, kind: str) -> float:
    near = set(WORD.findall(text[max(0, start - CONTEXT_CHARS) : start].lower())) | set(WORD.findall(text[stop : stop + CONTEXT_CHARS].lower()))
    up, down = len(near & FOR[kind]), len(near & AGAINST[kind])
    return round(min(1.0, max(0.0, START[kind] + 0.2 * min(up, 2) - 0.2 * min(down, 2))), 3)


def find_spans(text: str | None) -> list[tuple[int, int, int, float]]:
    """(start, kind's place, end, score), in order of start and kind."""
    out = []
    for a, k, b in sorted(proposals(text)) if text else ():
        s = score_of(text, a, b, KINDS[k])
        if k < len(BASE) or s >= ADDED_SCORE:
            out.append((a, k, b, s))
    return out


SCHEMA = "doc_id long, findings array<struct<start: long, rank: int, kind: string, stop: long, score: double>>"
FINDING = pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("kind", pa.string()), ("stop", pa.int64()), ("score", pa.float64())])


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, findings): a row per document with its spans and their scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            found = [[{"start": a, "rank": k, "kind": KINDS[k], "stop": b, "score": s} for a, k, b, s in find_spans(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(FINDING))], ["doc_id", "findings"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(read_table(spark, sf_dir, "documents"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")

    counts = [F.size(F.filter("findings", lambda x: x["rank"] == k)).cast("long").alias(f"n_{kind}") for k, kind in rank_kinds()]
    base = F.filter("findings", lambda x: x["rank"] < len(BASE))
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"), F.transform("findings", lambda x: x["score"]).alias("scores"))


def rank_kinds() -> list[tuple[int, str]]:
    return list(enumerate(BASE))
