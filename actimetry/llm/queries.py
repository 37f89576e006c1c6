"""Registered queries of this package and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from actimetry.llm import collocations, katz, manifest, personal_data, toxicity, url_trust, suffix_dedup, merkle, mixing, quality, decontaminate, simhash, secret_scan
from actimetry.llm.common import table


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op4_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op1_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trust.report(table(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.report(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.report(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.report(table(spark, sf_dir, "documents"))


def op11_katz_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op11_katz_scoring, op12_collocations, op13_merkle_manifest, op7_personal_data, op5_toxicity, op1_url_trust, op9_suffix_dedup, op4_merkle_fingerprint, op2_mixing, op10_quality_classifier, op3_decontaminate, op6_simhash_near_dedup, op8_secret_scan,)}
ORACLE: dict[str, str] = {"op1_url_trust": url_trust.REPORT_SQL, "op3_decontaminate": decontaminate.REPORT_SQL,
                          "op4_merkle_fingerprint": merkle.REPORT_SQL, "op13_merkle_manifest": manifest.REPORT_SQL,
                          "op12_collocations": collocations.REPORT_SQL, "op11_katz_scoring": katz.REPORT_SQL}
