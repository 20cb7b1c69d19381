"""From raw documents to tokens: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallgrass.llm import bpe, dedup, mixing, quality, simhash
from tallgrass.llm.common import stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked."""
    return simhash.keep_one(docs, simhash.SHINGLE, simhash.DISTANCE)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, begun copies whole; none where it takes nothing."""
    return mixing.repeated(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return bpe.digests(docs)


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix),
    ("tokens", tokens),
]

#: The classifier, SimHash and BPE are beyond SQL; a brute-force version tests the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
