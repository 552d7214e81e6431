"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import (
    bpe,
    exact_dedup,
    fingerprints,
    hard_negatives,
    jaccard_join,
    language_id,
    language_model,
    mixing,
    pii,
    prefix_trie,
    suffix_dedup,
    topk,
    url_reputation,
)
from wardline.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op2_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(table(spark, sf_dir, "embeddings"))


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    path = path or public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.code_texts(table(spark, sf_dir, "documents"), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(table(spark, sf_dir, "documents"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    return url_reputation.judge(pages, labels)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def cut_digests(docs: DataFrame, **settings) -> DataFrame:
    cut = suffix_dedup.remove_repeats(docs, **settings)
    removed = F.col("n_bytes") - F.octet_length("kept")
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.cast("long").alias("n_removed"),
        F.coalesce(F.size("starts"), F.lit(0)).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_digests(table(spark, sf_dir, "documents"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


REGISTRY = {
    "op1_pii": op1_pii,
    "op2_top_products": op2_top_products,
    "op3_language_model": op3_language_model,
    "op4_language_id": op4_language_id,
    "op5_bpe": op5_bpe,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_url_filters": op8_url_filters,
    "op9_mixing": op9_mixing,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_fingerprints": op11_fingerprints,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": pipeline,
}
