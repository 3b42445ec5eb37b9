"""From raw documents to packed training sequences: STAGES in order, each on all that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
Rows without text are empty documents, which the quality stage rejects; rows with equal doc_id are judged by their
own texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from halocline.llm import decontamination, exact_dedup, near_copies, packing, quality
from halocline.llm.common import materialize, read_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality reaches the threshold; the model learns from the labels outside the held-out fold."""
    return quality.keep_good(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def keep_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row, that with the largest id."""
    return exact_dedup.one_each(docs)


def keep_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (five-word shingles, similarity of 0.8 or more), one row, that with the smallest id."""
    return near_copies.keep_one(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with the benchmark."""
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their ids."""
    return packing.pack(docs, packing.tokenizer_file())


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", keep_exact),
    ("simhash near-dedup", keep_near),
    ("benchmark decontamination", keep_clean),
    ("packing", pack),
]

#: The classifier and the tokenizer have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
