"""The registered queries: every operator with its production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from siltbed.llm import (
    bagminhash,
    bpe,
    codes,
    decontaminate,
    fingerprints,
    mixing,
    phrases,
    pii,
    quality,
    recompression,
    secret_scan,
    toxicity,
    warc,
)
from siltbed.llm.common import table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprinted(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def op3_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


def op6_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.classes(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.coded(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_fingerprints,
        op2_secrets,
        op3_recompression,
        op4_pii,
        op5_warc,
        op6_bagminhash,
        op7_quality,
        op8_toxicity,
        op9_mixing,
        op10_decontamination,
        op11_bpe,
        op12_collocations,
        op13_codes,
    )
}
