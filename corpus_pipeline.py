"""From raw documents to packed training sequences, one operator after another."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm import line_dedup, near_copies, packing, quality, secret_scan, simhash
from rowtide.llm.common import documents, tokenizer_file
from rowtide.session import shared_dir


def _recounted(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars as its text now is; a null text keeps its number."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    return quality.keep_good(docs, documents(spark, sf_dir, "labels"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand on many sites but for where they come first."""
    return _recounted(line_dedup.remove_boilerplate(docs))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, similarity 0.8): the one with the smallest doc_id.

    Candidates are those of SimHash and, beyond its 3 bits, of min-hashes; all are verified.
    """
    return simhash.one_of_each(docs, near=near_copies.near_duplicates)


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return _recounted(secret_scan.mask_secrets(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.packed_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("simhash_near_dedup", near_deduplication),
    ("secret_scan", secret_masking),
    ("best_fit_packing", best_fit_packing),
]

#: Fingerprints, components and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each result written and read again as the next one's input."""
    docs, folder = documents(spark, sf_dir), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
