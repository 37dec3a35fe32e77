"""Registered queries of the numbered operators, each over its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import bpe, decontaminate, golay_dedup, grammar_ids, infill, kd_search, language_crf, line_dedup, periodic_runs, sharding, suffix_tree, url_templates, weak_labels
from weftline.llm.common import text_or_empty
from weftline.session import shared_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.repeated_lines(_table(spark, sf_dir, "documents"))


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_documents(_table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(text_or_empty("text").cast("binary")).alias("text_crc32"))
    return sharding.shard_by_bytes(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_search.top_products(_table(spark, sf_dir, "embeddings"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golay_dedup.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark).rstrip('/')}/token_ids/{uuid.uuid4().hex}"
    grammar_ids.write_shards(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return grammar_ids.read_digests(spark, folder)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of documents count for the pages whose path ends in the document's number."""
    bad = (F.col("toxic") == 1) | (F.col("quality") == 0)
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("number"), bad.alias("rejected"))
    return url_templates.judge_urls(_table(spark, sf_dir, "pages"), labels)


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_crf.predict_languages(_table(spark, sf_dir, "documents")).drop("spans")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(_table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.find_runs(docs))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(infill.infill(_table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_lm_scores, op3_bpe, op4_sharding, op5_decontamination, op6_exact_top_k, op7_simhash_near_dedup, op8_token_ids, op9_quality_classifier, op10_url_filters, op11_language_id, op12_periodic_runs, op13_fill_in_middle)}
