"""The registered queries of this package and, where SQL can say it, their twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowtide.llm import ann, bpe, langid, line_dedup, lm, merkle, packing, pii, quality, quality_net, secret_scan, simhash, whitening
from rowtide.llm.common import documents, tokenizer_file
from rowtide.plans.registry import Registry

LLM = Registry()


@LLM.query(line_dedup.ORACLE)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(documents(spark, sf_dir))


@LLM.query()
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
    return judged.drop("version")


@LLM.query()
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(documents(spark, sf_dir))


@LLM.query()
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_report(documents(spark, sf_dir))


@LLM.query()
def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_personal(documents(spark, sf_dir).select("doc_id", "text"), count="n_replaced")


@LLM.query()
def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


@LLM.query()
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"))


@LLM.query()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


@LLM.query()
def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.filter("vec_id % 100 = 0"))


@LLM.query()
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir))


@LLM.query(merkle.ORACLE)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


@LLM.query()
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(documents(spark, sf_dir, "embeddings"))


@LLM.query()
def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_net.rate(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
