"""Corpus pipeline over the documents table: quality rules, near-duplicates, decontamination, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arenaspark.llm import decontam, packing, pii, quality, simhash
from arenaspark.llm.common import read, shared_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the base rule or a learned rule rejects go."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: one document of each SimHash class stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that contain a benchmark item go."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: personal data become placeholders."""
    return pii.mask_pii(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: what is left is packed into sequences of 2048 tokens."""
    return packing.pack(docs, slice_bytes=1 << 20)  # the executors still hold memory of the stages before


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: Learned rules, bit votes and tokenisation have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each stage's result is written and read again before the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
