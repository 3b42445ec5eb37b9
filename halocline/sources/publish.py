"""Publishing manifests by version: a new version only when the content has changed, and none is ever overwritten.

A version is a folder ``manifest_<version>`` with the tables of ``sources.manifest``; its specification keeps a digest
of the content, which does not depend on the order of rows or on how they are spread over files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from halocline.functions import names
from halocline.sources import manifest
from halocline.sources.shared import exists, finished

FIRST = "1.0.0"


def content_digest(*tables: DataFrame) -> str:
    """A digest of tables as sets of rows with their counts, by one aggregation each; columns count by name, not by place.

    Two sums over 64-bit hashes of the rows, so the order of rows does not matter, and a row twice is not a row missing.
    """
    parts = []
    for t in tables:
        columns = [F.col(f"`{c}`") for c in sorted(t.columns)]
        row = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
        once = F.sum(F.xxhash64(row).cast("decimal(38,0)"))
        again = F.sum(F.xxhash64(F.lit("again"), row).cast("decimal(38,0)"))
        n, a, b = t.agg(F.count("*"), once, again).first()
        parts.append(f"{','.join(sorted(t.columns))}:{n}:{a or 0}:{b or 0}")
    return parts_digest(parts)


def parts_digest(parts: list[str]) -> str:
    import hashlib

    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def next_version(version: str) -> str:
    """The patch version counted up."""
    major, minor, patch = version.split(".")
    return f"{int(major)}.{int(minor)}.{int(patch) + 1}"


def bumped(version: Column) -> Column:
    v = names.semver(version)
    return F.concat_ws(".", v["major"], v["minor"], v["patch"] + 1)


def published(spark: SparkSession, base: str) -> list[str]:
    """Versions whose specification was written to its end, least first, as numbers and not as text."""
    folders = {f.removeprefix("manifest_") for f in whole_folders(spark, base)}
    return sorted((v for v in folders if all(p.isdigit() for p in v.split(".")) and v.count(".") == 2), key=lambda v: tuple(map(int, v.split("."))))


def whole_folders(spark: SparkSession, base: str) -> list[str]:
    return finished(spark, f"{base}/done")


def latest(spark: SparkSession, base: str) -> str | None:
    versions = published(spark, base)
    return versions[-1] if versions else None


def digest_of(spark: SparkSession, base: str, version: str) -> str:
    return spark.read.schema("digest string").json(f"{base}/done/manifest_{version}").first().digest


def publish(spec: DataFrame, locations: DataFrame, index: DataFrame, points: DataFrame, base: str, version: str | None = None) -> tuple[str, bool]:
    """(version, whether it is new): write the manifest under a new version if it is not what the latest version holds.

    Without ``version`` the latest one's patch number is counted up.  A given version that is published already with
    other content is refused; with the same content nothing is done.  What a publication that died has left is written
    again: a version counts once its note under ``done`` is there.
    """
    spark = spec.sparkSession
    known = [c for c in spec.columns if c != "manifest_version"]
    digest = content_digest(spec.select(*known), locations, index, points)
    last = latest(spark, base)
    if version is None:
        if last is not None and digest_of(spark, base, last) == digest:
            return last, False
        version = next_version(last) if last else FIRST
    elif version in published(spark, base):
        if digest_of(spark, base, version) == digest:
            return version, False
        raise ValueError(f"manifest {version} is published with other content; it is not overwritten")
    manifest.write(spec.withColumn("manifest_version", F.lit(version)), locations, index, points, f"{base}/manifest_{version}")
    spark.createDataFrame([(digest,)], "digest string").coalesce(1).write.mode("overwrite").json(f"{base}/done/manifest_{version}")
    return version, True


def load(spark: SparkSession, base: str, version: str | None = None) -> manifest.Manifest:
    """A published manifest, the latest by default."""
    version = version or latest(spark, base)
    if version is None or not exists(spark, f"{base}/done/manifest_{version}/_SUCCESS"):
        raise ValueError(f"no published manifest {version or ''} in {base}")
    return manifest.load(spark, f"{base}/manifest_{version}")
