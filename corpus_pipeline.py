"""A training corpus from raw documents: each stage works on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hydroflow.llm import decontaminate, exact_dedup, mixing, quality, simhash
from hydroflow.llm.common import table
from hydroflow.session import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels, rejects go."""
    return quality.keep_accepted(docs, table(spark, sf_dir, "labels"))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def keep_one_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints the one with the smallest id stays."""
    return simhash.drop_near_duplicates(docs, width=simhash.SHINGLE_WORDS, max_bits=simhash.MAX_BITS)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them, with the pass, block and weight that they came by."""
    return mixing.mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("exact_dedup", keep_one_copy),
    ("simhash", keep_one_near_copy),
    ("decontamination", keep_uncontaminated),
    ("mixing", mix),
]

#: A classifier and fingerprints cannot be said in SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
