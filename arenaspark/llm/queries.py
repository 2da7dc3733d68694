"""Registered queries of the training-data operators: op<N>_<name>(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenaspark.llm import decontam, jaccard, langid, licenses, negatives, oracle, packing, passages, pii, quality, simhash, tokenfile, trie, warc
from arenaspark.llm.common import read


def op1_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data of every document: base counts and digest, all spans."""
    return pii.find_pii(read(spark, sf, "documents"))


def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    out = simhash.near_duplicates(read(spark, sf, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_licenses(spark: SparkSession, sf: str) -> DataFrame:
    """License phrases and template labels of every document."""
    return licenses.scan_licenses(read(spark, sf, "documents"))


def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Captures of all pages, read back from the archives."""
    return warc.captures(read(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces of all documents packed into sequences of 2048 tokens."""
    return packing.pack(read(spark, sf, "documents"))


def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality counts and the learned verdict of every document."""
    return quality.quality_verdicts(read(spark, sf, "documents"), read(spark, sf, "labels")).drop("text_hash")


def op7_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids of all documents, read back from the token files."""
    return tokenfile.token_files(read(spark, sf, "documents"))


def op8_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that contain a benchmark item, re-parameterised or not."""
    return decontam.contaminated(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


def op9_passages(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a passage that another document has too."""
    return passages.repeated_passages(read(spark, sf, "documents"))


def op10_language(spark: SparkSession, sf: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify(read(spark, sf, "documents"))


def op11_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate class of every document by the Jaccard similarity of its 5-word shingles."""
    return jaccard.jaccard_classes(read(spark, sf, "documents"))


def op12_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Hard negatives of every anchor and positive; ids divisible by 7 take the next label first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(read(spark, sf, "embeddings").withColumn("label", label))


def op13_trie(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return trie.prefix_trie(read(spark, sf, "conversations"))


REGISTRY = {f.__name__: f for f in (op1_pii, op2_simhash, op3_licenses, op4_warc, op5_packing, op6_quality, op7_tokens,
                                    op8_decontamination, op9_passages, op10_language, op11_jaccard,
                                    op12_negatives, op13_trie)}
# SQL has no XXH64, Luhn offsets, tokenizers, learned rules, chains or vectors: those queries are tested against brute force
ORACLE = {"op3_licenses": oracle.licenses_sql(), "op4_warc": oracle.WARC_SQL, "op11_jaccard": oracle.JACCARD_SQL,
          "op12_negatives": oracle.NEGATIVES_SQL, "op13_trie": oracle.TRIE_SQL}
