"""Registered queries of the subpackage, each beside its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillsift.llm import (
    compression_quality,
    merkle,
    near_dedup,
    ngram_quality,
    packing,
    pii,
    sentencepiece_lattice,
    sharding,
    suffix_dedup,
    topk,
    toxicity,
    url_filter,
    whitening,
)
from quillsift.llm.staging import table

# The rules that the contract of op7 states.
URL_RULES = """
allow com/
block example.com/en/
allow www.example.com/en/
block net/es/
block net/fr/
"""


def op1_sentencepiece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_lattice.encode_documents(spark, docs, model)


def op2_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(spark, docs, public_tokenizers.path("word_bpe_49k.json"))


def op3_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score_documents(spark, docs, labels)


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_dedup.near_classes(spark, table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "kept")


def op5_maxscore_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search_embeddings(table(spark, sf_dir, "embeddings"))


def op6_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"))


def op7_bloom_cascade_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filter.rules_of(URL_RULES)
    return url_filter.judge_urls(spark, table(spark, sf_dir, "pages"), rules)


def op8_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op9_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_quality.judged(spark, table(spark, sf_dir, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_bytes(spark, table(spark, sf_dir, "documents"))


def op11_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_embeddings(spark, table(spark, sf_dir, "embeddings"))


def op12_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return compression_quality.score_documents(spark, docs, labels)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_documents(spark, table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_sentencepiece_lattice,
        op2_genetic_packing,
        op3_lexicon_toxicity,
        op4_order_minhash,
        op5_maxscore_top_k,
        op6_feistel_pseudonyms,
        op7_bloom_cascade_urls,
        op8_hash_tree_shards,
        op9_kneser_ney_quality,
        op10_suffix_array_dedup,
        op11_qdwh_whitening,
        op12_compression_quality,
        op13_merkle_manifest,
    )
}

ORACLE: dict[str, str] = {
    "op5_maxscore_top_k": topk.oracle_sql(),
    "op13_merkle_manifest": merkle.oracle_sql(),
    "op7_bloom_cascade_urls": url_filter.oracle_sql(url_filter.rules_of(URL_RULES)),
}
