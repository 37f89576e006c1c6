"""The corpus pipeline: STAGES in order over ``documents``, each written and read again.

1. quality classifier: documents scored under the threshold go;
2. SimHash near-dedup: the smallest doc_id of each group of linked fingerprints stays;
3. benchmark decontamination: documents that hold a window of a test item go;
4. secret scans: every secret found is replaced by a mark in the text, all documents stay;
5. mixing: documents are drawn by probabilities raked to source, language and topic targets.

Defined results: a null text counts as empty in every stage (it is scored, has the fingerprint zero like every wordless text, holds no
test item and no secret, and has no tokens); a null doc_id is never trained on and never goes as a copy; null source and lang are the
value "(none)" of the mixing. Rows with the same doc_id are judged by their own texts, are drawn alike, and of rows that tie for the
smallest doc_id of a group all stay. Very long texts are read whole. An empty table gives an empty table with the stage's columns, at every
stage. Extra columns are kept under their names, whatever these are; the last stage's three replace columns of the same names.

All stages but the last return the columns of ``documents``; the last adds mix_topic, mix_weight and
mix_copies. No stage can be expressed in plain SQL as a whole (a trained model, components, an
iterated fit), so ORACLE_SQL is None and the stages are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from actimetry.llm import decontaminate, mixing, quality, secret_scan, simhash
from actimetry.llm.common import materialise, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), quality.THRESHOLD)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, simhash.SHINGLE, simhash.DISTANCE)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"), decontaminate.WINDOW, max_coverage=0.0)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample(docs)


STAGES = [
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", mask_secrets),
    ("mixing", mix_sources),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
