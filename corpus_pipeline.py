"""The corpus pipeline: toxicity, near-duplicates, benchmark decontamination, personal data, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes a
stage's result as Parquet in the shared scratch folder and reads it back as the
next one's input, so a lost executor repeats a part of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltbed.llm import bagminhash, decontaminate, mixing, pii, toxicity
from siltbed.llm.common import stored, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that score as toxic."""
    return toxicity.keep_non_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of every class of near-duplicates."""
    return bagminhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that contain a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts."""
    return pii.mask(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the mix takes words of, with the number of words taken."""
    return mixing.mix_sources(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("mixing", mixing_stage),
]

#: SQL cannot express the trained classifier and the signatures; tests hold the operators against brute force, and the run's columns and ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
