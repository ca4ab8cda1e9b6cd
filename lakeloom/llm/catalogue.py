"""Registered queries of the training-data operators and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import (
    byte_bpe, clustering, embeddings, exact_dedup, html_text, licenses, minhash, mixing, packing, sharding, spelling, substrings, toxicity,
)
from lakeloom.llm._shared import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_karmarkar_karp_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_cross_polytope_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op3_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents", "doc_id", "source", "text"))


def op4_nearest_url_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op5_bottom_k_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), shingle=2, percent=80)


def op6_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.score_documents(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op7_digest_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_grouping_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_conditional_compression_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_suffix_automaton_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_sorted_list_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_matrix_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trips(table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_shallot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.clustered(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def queries() -> dict[str, Query]:
    found = (
        op1_karmarkar_karp_shards, op2_cross_polytope_vectors, op3_pivotal_mix, op4_nearest_url_text,
        op5_bottom_k_near_dedup, op6_string_kernel_toxicity, op7_digest_tree_dedup, op8_grouping_genetic_packing,
        op9_conditional_compression_licenses, op10_suffix_automaton_dedup,
        op11_sorted_list_spelling, op12_matrix_byte_bpe, op13_shallot_clusters,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op7_digest_tree_dedup": exact_dedup.ORACLE_SQL, "op13_shallot_clusters": clustering.ORACLE_SQL}
