"""URL filters by a Bloom filter cascade, in DataFrame operations only.

Listed keys are host suffixes, alone or with the start of a path.  Level 1 of the cascade encodes the listed
keys; level 2 the keys of the corpus that level 1 takes for listed but are not; level 3 the listed keys that
level 2 takes for those; and so on until no key is taken wrongly.  As the levels are built over the complete
universe of keys that the corpus can ask for, a key's first level that rejects it decides exactly, without a
join; listed keys that the corpus cannot ask for need no bits.  Levels are bit arrays of at most ``max_bits``, which
go to the tasks as values of their expressions; when the keys need more, they are dealt by a hash to shards with
a cascade each, which are asked one after the other.

A url asks for every suffix of its host, alone and with each start of its path that has the length of a listed
path.  The longest listed key wins, first by host, then by path.

The list of hosts is a parameter: names, or a table of any size with a column ``host``.

Edge cases: a null url, or one without ``://``, has an empty host and path and fits no key; repeated rows give a
row each; further columns are ignored; an empty table gives no rows; an empty list lets every url through; null,
empty and repeated hosts of a list do nothing more.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from halocline.llm.common import lower_ascii, materialize, read_table

# The rules of the queries' contract, (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Hosts listed without a path, with the verdict for urls that no rule fits.
BLOCKED_HOSTS = ("ads-track.example.com", "casino-win.example.com", "cheap-pills.example.com", "free-bets.example.com", "spam-farm.example.com", "spam-farm.example.org")

BITS_PER_KEY = 12
PROBES = 6
#: Bits of a level of one shard: 2 MB of bitmap sent to each task.
MAX_BITS = 1 << 24


def host_of(url: str = "url") -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return lower_ascii(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: str = "url") -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def asked_keys(host: Column, path: Column, lengths: Iterable[int]) -> Column:
    """All keys of a url, the longest host first and for each host the longest path first."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.array_compact(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(set(lengths), reverse=True)]))
    keys = F.flatten(F.transform(suffixes, lambda h: F.transform(starts, lambda p: F.concat(h, F.lit(" "), p))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(keys)


def hashes(key: Column) -> tuple[Column, Column]:
    """Two independent hashes of a key, from which all its places come."""
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key)


def places(first: Column, second: Column, bits: int, level: int) -> list[Column]:
    """The places of a key in a level whose number of bits is a power of two."""
    start, step = (F.xxhash64(h, F.lit(level)).bitwiseAND(bits - 1) for h in (first, second))
    return [(start + F.lit(i) * step.bitwiseOR(F.lit(1))).bitwiseAND(bits - 1) for i in range(PROBES)]


def bitmap(keys: DataFrame, bits: int, level: int) -> DataFrame:
    """One row: the 64-bit words of a Bloom filter over the column ``key``, as an array."""
    spark = keys.sparkSession
    place = keys.select(F.explode(F.array(*places(*hashes(F.col("key")), bits, level))).alias("p"))
    words = place.select(F.expr("cast(p div 64 as int)").alias("w"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("v"))
    every = spark.range(bits // 64).select(F.col("id").cast("int").alias("w"), F.lit(0).cast("long").alias("v"))
    filled = words.groupBy("w").agg(F.bit_or("v").alias("v")).unionByName(every).groupBy("w").agg(F.bit_or("v").alias("v"))
    return filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "v"))), lambda x: x["v"]).alias("words"))  # bits / 64 rows


class Cascade:
    """Exact membership of keys in a list, over the universe of keys it was built for."""

    def __init__(self, universe: DataFrame, listed: DataFrame, bits_per_key: int = BITS_PER_KEY, max_bits: int = MAX_BITS) -> None:
        """``universe`` and ``listed`` have a column ``key``; the keys of both are told apart in one aggregation."""
        tagged = universe.select("key", F.lit(False).alias("in_list"), F.lit(True).alias("asked")).unionByName(listed.select("key", F.lit(True).alias("in_list"), F.lit(False).alias("asked")))
        self.keys = materialize(tagged.groupBy("key").agg(F.max("in_list").alias("in_list"), F.max("asked").alias("asked")).where("asked").drop("asked"))
        self.bits_per_key, self.max_bits = bits_per_key, max_bits
        self.shards = max(1, -(-self.keys.where("in_list").count() * bits_per_key // max_bits))

    def in_shard(self, key: Column, shard: int) -> Column:
        return F.pmod(F.xxhash64(F.lit("shard"), key), F.lit(self.shards)) == shard

    def levels(self, shard: int) -> list[tuple[Column, int]]:
        """The levels of a shard, each a bitmap of at most max_bits and its number of bits."""
        levels: list[tuple[Column, int]] = []
        left = self.keys.where(self.in_shard(F.col("key"), shard))  # the keys that all levels so far take
        while True:
            side = len(levels) % 2 == 0  # a level encodes the keys of its own side
            sizes = left.agg(F.count(F.when(F.col("in_list") == side, 1)).alias("own"), F.count(F.when(F.col("in_list") != side, 1)).alias("other")).first()
            if not sizes["own"]:
                return levels
            bits = 64
            while bits < min(sizes["own"] * self.bits_per_key, self.max_bits):
                bits *= 2
            words = bitmap(left.where(F.col("in_list") == side).select("key"), bits, len(levels)).first()["words"]  # bits / 64 numbers
            levels.append((F.lit(b"".join(w.to_bytes(8, "little", signed=True) for w in words)), bits))
            if not sizes["other"]:
                return levels
            # all of its own side pass; of the others only false positives are left
            left = materialize(left.where((F.col("in_list") == side) | takes(*hashes(F.col("key")), levels[-1], len(levels) - 1)))

    def member(self, shard: int, levels: list[tuple[Column, int]], key: Column, first: Column, second: Column) -> Column:
        """Whether a key of the universe, with its hashes, is listed in this shard: the first level to reject it tells."""
        inside = F.lit(len(levels) % 2 == 1)
        for at in reversed(range(len(levels))):
            inside = F.when(takes(first, second, levels[at], at), inside).otherwise(F.lit(at % 2 == 1))
        return inside if self.shards == 1 else self.in_shard(key, shard) & inside


def takes(first: Column, second: Column, level: tuple[Column, int], at: int) -> Column:
    """Whether all bits of a key with these hashes are set in a level."""
    packed, bits = level

    def is_set(place: Column) -> Column:  # most keys fail at their first or second place, which ends the test
        byte = F.substring(packed, F.shiftright(place, 3).cast("int") + 1, F.lit(1))
        return F.getbit(F.ascii(F.decode(byte, "ISO-8859-1")), place.bitwiseAND(7).cast("int")) == 1

    return reduce(and_, map(is_set, places(first, second, bits, at)))


def listed_keys(spark: SparkSession, rules: Iterable[tuple[str, str, str]], hosts: Iterable[str] | DataFrame) -> DataFrame:
    """The column ``key`` of rules and hosts."""

    def rows(values: list[str]) -> DataFrame:
        return spark.range(1).select(F.explode(F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")).alias("key"))

    own = hosts.select(F.concat(lower_ascii(F.col("host")), F.lit(" ")).alias("key")).where("key <> ' '") if isinstance(hosts, DataFrame) else rows([f"{lower(h)} " for h in hosts])
    return rows([f"{host} {path}" for _, host, path in rules]).unionByName(own)


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, hosts: Iterable[str] | DataFrame = BLOCKED_HOSTS, **sizes: int) -> DataFrame:
    """(page_id, host, path, rule, listed_host, verdict) for every row of ``pages``."""
    rules = [(v, lower(h), p) for v, h, p in rules]
    lengths = {0, *(len(p) for _, _, p in rules)}
    split = pages.select("page_id", host_of().alias("host"), path_of().alias("path"))
    keys = asked_keys(F.col("host"), F.col("path"), lengths)
    cascade = Cascade(split.select(F.explode(keys).alias("key")), listed_keys(pages.sparkSession, rules, hosts), **sizes)

    def hashed(key: Column) -> Column:
        first, second = hashes(key)
        return F.struct(key.alias("key"), first.alias("first"), second.alias("second"))

    found = split.withColumn("keys", F.transform(keys, hashed)).withColumn("listed", F.array().cast("array<string>"))

    def listed_in(shard: int, levels: list[tuple[Column, int]]) -> Column:
        return F.filter("keys", lambda x: cascade.member(shard, levels, x["key"], x["first"], x["second"]))

    for shard in range(cascade.shards):  # one shard's levels at a time; page texts are not carried along
        hits = listed_in(shard, cascade.levels(shard))
        found = found.withColumn("listed", F.concat("listed", F.transform(hits, lambda x: x["key"])))
        if cascade.shards > 1:
            found = materialize(found)
    found = found.withColumn("found", F.filter(F.transform("keys", lambda x: x["key"]), lambda k: F.array_contains("listed", k)))
    # keys with a path are rules, keys without are listed hosts
    rule_key = F.get(F.filter("found", lambda k: ~k.endswith(" ")), F.lit(0))
    host_key = F.get(F.filter("found", lambda k: k.endswith(" ")), F.lit(0))
    named = found.select("page_id", "host", "path", F.replace(rule_key, F.lit(" "), F.lit("")).alias("rule"), F.rtrim(host_key).alias("listed_host"))
    verdict = F.lit(None).cast("string")
    for v, h, p in rules:
        verdict = F.when(F.col("rule") == h + p, F.lit(v)).otherwise(verdict)
    return named.withColumn("verdict", F.coalesce(verdict, F.when(F.col("listed_host").isNotNull(), "block").otherwise("allow")))


def lower(host: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read_table(spark, sf_dir, "pages"))


ORACLE_SQL = {
    "op4_url_filter": rf"""
        WITH cut AS (
            SELECT page_id,
                   CASE WHEN contains(url, '://') THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
                   CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
            FROM pages),
        ruled AS (
            SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                           WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                           WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                           WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule,
                   {" ".join(f"CASE WHEN host = '{h}' OR host LIKE '%.{h}' THEN '{h}' ELSE" for h in BLOCKED_HOSTS)} NULL {"END " * len(BLOCKED_HOSTS)} AS listed_host
            FROM cut)
        SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
                       WHEN listed_host IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled"""
}
