"""The registered queries of the training-data operators, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import archives, decontaminate, fingerprints, importance, linededup, merkle, mixing, quality, secrets, simhash, tokencounts, tokenfiles, toxicity
from .common import read


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup(read(spark, sf_dir, "pages"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(read(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(read(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.digest(read(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.digest(read(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.digest(read(spark, sf_dir, "pages"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(read(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(read(spark, sf_dir, "documents"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digest(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_line_dedup,
        op3_secrets,
        op4_mix_sources,
        op5_toxicity,
        op6_quality_rules,
        op7_token_ids,
        op8_token_counts,
        op9_warc,
        op10_simhash,
        op11_importance_resampling,
        op12_merkle_manifest,
        op13_fingerprints,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": decontaminate.ORACLE,
    "op2_line_dedup": linededup.ORACLE,
    "op4_mix_sources": mixing.ORACLE,
    "op9_warc": archives.ORACLE,
    "op11_importance_resampling": importance.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
}
