"""Secret scans over an incremental blob ledger, in DataFrame operations only.

Every version of a file (here: a document's text) is addressed by the SHA-256 of its content.  A ledger
row holds a blob, the rule versions it was scanned with, and the spans found.  A scan takes only the (blob, rule
version) pairs that the ledger has not seen, so equal contents are scanned once and a new rule version scans old
blobs with that rule alone; findings are then joined back to all paths of a blob.

Spans are code points, end exclusive.  Each kind's matches are leftmost and non-overlapping; a match that fails
its length test is dropped and its text is not tried again.  Added kinds stand beside the base ones:
``header`` (private key blocks) and ``bearer`` (authorization headers).

Edge cases: a null text is an empty blob; repeated rows are paths of one blob, and give a row each; a null path
id keeps its row; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from halocline.llm.common import committed, materialize, read_table, shared_dir, text_or_empty


@dataclass(frozen=True)
class Rule:
    """A kind of secret.  ``pattern`` is a whole match; ``tested`` its part that must have ``least`` characters."""

    kind: str
    pattern: str
    least: int = 0
    tested: str = ""  # a pattern whose group 1 is tested, the whole match if empty
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.version}"


# The base kinds, as the queries' contract states them.
ASSIGN_HEAD = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
BASE = (
    Rule("assign", ASSIGN_HEAD + r"[A-Za-z0-9+/_.=-]+", 6, "^" + ASSIGN_HEAD + r"([A-Za-z0-9+/_.=-]+)"),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
ADDED = (
    Rule("header", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/=-]+", 24),
)
RULES = BASE + ADDED
#: Runs shorter than a rule's least length need not be cut out where the whole match is tested.
CUT = {"access": r"AKIA[A-Z0-9]{16,}+", "hex": r"[0-9a-f]{24,}+"}
MARK = "\u0001"
LEDGER = "blob binary, scanned array<string>, findings array<struct<start: int, rank: int, kind: string, stop: int>>"


def blob_id(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def update_ledger(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows to append to the ledger: each new or newly scanned blob of ``versions`` (column ``text``).

    Contents are grouped by their address before the scan; a group of any size is one row per task before the
    shuffle.  A text is split at a rule's matches, whose places are running lengths within the blob.
    """
    text = text_or_empty()
    blobs = versions.select(blob_id(text).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    scanned = F.array(*[F.lit(r.name) for r in rules])
    if ledger is not None:
        seen = ledger.groupBy("blob").agg(F.flatten(F.collect_set("scanned")).alias("seen"))
        blobs = blobs.join(seen.hint("merge"), "blob", "left")
        scanned = F.array_except(scanned, F.coalesce("seen", F.array().cast("array<string>")))
    blobs = blobs.withColumn("scanned", scanned).where(F.size("scanned") > 0)

    plain = F.translate("text", MARK, "\u0002")  # neither is in any pattern, and places do not move
    cuts = []
    for rank, rule in enumerate(rules):
        cut = CUT.get(rule.kind, rule.pattern)
        pieces = F.split(F.regexp_replace(plain, f"({cut})", f"{MARK}$1{MARK}"), MARK)
        cuts.append(F.when(F.array_contains("scanned", rule.name) & F.col("text").rlike(cut), F.struct(F.lit(rank).alias("rank"), pieces.alias("pieces"))))
    split = blobs.select("blob", "scanned", F.explode_outer(F.array_compact(F.array(*cuts))).alias("cut"))
    rows = split.select("blob", "scanned", "cut.rank", F.posexplode_outer("cut.pieces").alias("at", "piece"))
    rows = rows.select("blob", "scanned", "rank", "at", F.length("piece").alias("length"), F.when(F.col("at") % 2 == 1, F.col("piece")).alias("match"))
    stop = F.sum("length").over(Window.partitionBy("blob", "rank").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int")

    def by_rank(value) -> Column:
        return F.element_at(F.array(*[value(r) for r in rules]), F.col("rank") + 1)

    tested = by_rank(lambda r: F.length(F.regexp_extract("match", r.tested, 1)) if r.tested else F.col("length"))
    passed = F.col("match").isNotNull() & (tested >= by_rank(lambda r: F.lit(r.least)))
    span = F.struct((F.col("stop") - F.col("length")).alias("start"), "rank", by_rank(lambda r: F.lit(r.kind)).alias("kind"), "stop")
    return rows.withColumn("stop", stop).groupBy("blob").agg(F.first("scanned").alias("scanned"), F.array_sort(F.collect_list(F.when(passed, span))).alias("findings"))


def findings_of(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, findings) over all of a blob's ledger rows, of the rules' present versions."""
    names = F.array(*[F.lit(r.name) for r in rules])
    current = F.filter("findings", lambda x: F.array_contains(F.array_intersect(F.col("scanned"), names), F.concat_ws(":", x["kind"], F.element_at(F.create_map(*[v for r in rules for v in (F.lit(r.kind), F.lit(r.version))]), x["kind"]))))
    rows = ledger.select("blob", current.alias("findings"))
    return rows.groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("findings")))).alias("findings"))


def join_back(versions: DataFrame, findings: DataFrame) -> DataFrame:
    """A row per version: all its columns but the text, its blob, and the findings in it."""
    paths = versions.withColumn("blob", blob_id(text_or_empty())).drop("text")
    return paths.join(findings.hint("merge"), "blob")


class BlobLedger:
    """A ledger kept as Parquet in a folder; each scan appends what it found.

    The folder is all its state: a ledger opened on it later goes on where the last scan ended.  A scan counts once its
    part is written to the end, so one that died is done again over what it left.
    """

    def __init__(self, spark: SparkSession, path: str, rules: tuple[Rule, ...] = RULES) -> None:
        self.spark, self.path, self.rules = spark, path, rules

    @property
    def parts(self) -> list[str]:
        return [f"{self.path}/{name}" for name in committed(self.spark, self.path)]

    def read(self) -> DataFrame | None:
        parts = self.parts
        return self.spark.read.schema(LEDGER).parquet(*parts) if parts else None

    def scan(self, versions: DataFrame) -> DataFrame:
        """Scan what is new in ``versions`` and return all of their rows with findings."""
        asked = materialize(versions.select(blob_id(text_or_empty()).alias("blob")).distinct())
        earlier = self.of_blobs(asked)
        # scans that run at one time write parts of their own; what both have scanned is the same
        part = f"{self.path}/scan-{len(self.parts):05d}-{uuid.uuid4().hex[:12]}"
        update_ledger(versions, earlier, self.rules).write.parquet(part)
        return join_back(versions, materialize(findings_of(self.of_blobs(asked), self.rules)))  # written, so that Spark may split a hot blob's paths

    def of_blobs(self, asked: DataFrame) -> DataFrame | None:
        """The ledger's rows of some blobs: a scan's cost past its own texts is one pass over the ledger's addresses."""
        ledger = self.read()
        return None if ledger is None else ledger.join(asked.hint("merge"), "blob", "left_semi")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = BlobLedger(spark, shared_dir(spark)).scan(versions)

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")

    base = F.filter("findings", lambda x: x["rank"] < len(BASE))
    return found.select("doc_id", *[count(r.kind) for r in BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))


def oracle_sql() -> str:
    """The same spans from DuckDB: texts split at each rule's matches, places as running lengths."""
    quoted = lambda p: p.replace("'", "''")
    parts = []
    for rank, r in enumerate(RULES):
        pieces = f"string_split(regexp_replace(text, '({quoted(r.pattern)})', chr(1) || '\\1' || chr(1), 'g'), chr(1))"
        tested = f"length(regexp_extract(piece, '{quoted(r.tested)}', 1))" if r.tested else "length(piece)"
        parts.append(f"""SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, stop - length(piece) AS start, stop FROM (
            SELECT doc_id, i, piece, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT AS stop FROM (
                SELECT doc_id, unnest(s) AS piece, generate_subscripts(s, 1) AS i FROM (SELECT doc_id, {pieces} AS s FROM t)))
            WHERE i % 2 = 0 AND {tested} >= {r.least}""")
    counts = ", ".join(f"count(*) FILTER (rank = {k}) AS n_{r.kind}" for k, r in enumerate(BASE))
    named = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)"
    return f"""
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), chr(1), chr(2)) AS text FROM documents),
        spans AS ({" UNION ALL ".join(parts)}),
        found AS (SELECT doc_id, {counts}, {named} AS spans, {named} FILTER (rank < {len(BASE)}) AS base FROM spans GROUP BY doc_id)
        SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM t LEFT JOIN found USING (doc_id)"""


ORACLE_SQL = {"op1_secret_scan": oracle_sql()}
