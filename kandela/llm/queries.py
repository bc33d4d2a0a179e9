"""Registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversations, covertree, hamming, minhash, mixing, packing, personal, quality, runs, secrets, sharding, spans, url_filter
from .common import table

#: Host, path and verdict of each rule.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_multi_index_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.top_k(table(spark, sf_dir, "embeddings"), k=10)


def op3_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op4_forest_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(table(spark, sf_dir, "documents"))


def op5_configuration_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


def op8_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), shards=24)


def op9_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules)


def op10_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_digests(conversations.damaged(table(spark, sf_dir, "conversations")))


def op12_maximal_pair_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(table(spark, sf_dir, "documents"))


def op13_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.span_digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentence_spans": op1_sentence_spans,
    "op2_multi_index_hamming": op2_multi_index_hamming,
    "op3_tensored_minhash": op3_tensored_minhash,
    "op4_forest_secrets": op4_forest_secrets,
    "op5_configuration_packing": op5_configuration_packing,
    "op6_ftrl_quality": op6_ftrl_quality,
    "op7_pivotal_mixing": op7_pivotal_mixing,
    "op8_stratified_shards": op8_stratified_shards,
    "op9_bloom_cascade": op9_bloom_cascade,
    "op10_cover_tree": op10_cover_tree,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_maximal_pair_runs": op12_maximal_pair_runs,
    "op13_boosted_pii": op13_boosted_pii,
}
