"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup, packing, each over all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from benchbook.llm import exact_dedup, language, packing, simhash
from benchbook.llm.common import materialize, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose predicted language is a learned one, and fills in languages that are null; rejects what has none."""
    return language.keep_known(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to blanks the longest stays, then the smallest id."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a five-word similarity of 0.8 or more, found by SimHash fingerprints, the smallest id stays."""
    return simhash.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents in sequences of at most 1024 ids."""
    return packing.pack(docs)


STAGES = [("language", known_language), ("exact_dedup", exact), ("near_dedup", near), ("packing", packed)]

#: SQL can't express tokenizing and the training of the language filter; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written to the shared folder and read back for the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
