"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (filter_audit, hmm, hnsw, importance, mixing, mtree, ngram_join, packing, prefix_hashes, pseudonyms, quality, secret_scan,
               statements, wordpieces)
from .common import remainder, table

WORD_BPE = "word_bpe_49k.json"


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with held_out, score and predicted; held-out labels are not learned from."""
    learned = labels.where(remainder("doc_id", 4) != 2).select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(docs, learned)
    return quality.score(docs, model).withColumn("held_out", remainder("doc_id", 4) == 2).withColumn(
        "predicted", (F.col("score") >= 0.7).cast("int"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_scores(docs.select("doc_id", "text"), labels).select("doc_id", "held_out", "score", "predicted")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.with_spans(docs, secret_scan.cuts(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in secret_scan.KINDS],
                        F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"),
                        secret_scan.listed(F.col("spans")).alias("spans"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op1_hidden_markov_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = hmm.scored(docs, remainder("doc_id", 7) != 2)
    return found.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymised(docs, key="op2", counts=True)


def op6_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.highest_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return wordpieces.token_counts(docs, public_tokenizers.path(WORD_BPE)).drop("text")


def op8_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_documents(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op9_hnsw_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = ngram_join.similar_groups(table(spark, sf_dir, "documents"), n=3, num=90, den=100)
    return groups.withColumnRenamed("size", "n_shingles")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.failure_masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance.resampled(docs, table(spark, sf_dir, "benchmark").select("text"))


def op13_prefix_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_hashes.compared_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_hidden_markov_scores, op2_feistel_pseudonyms, op3_quality_classifier, op4_secret_scan, op5_best_fit_packing, op6_mtree_top_k,
        op7_token_counts, op8_pareto_mixing, op9_hnsw_neighbours, op10_ngram_jaccard_join, op11_filter_audit, op12_importance_resampling,
        op13_prefix_fingerprints)}

#: Operators that learn, or whose method leaves more than one right result, have no statement; tests
#: hold them against brute force.
ORACLE_SQL: dict[str, str] = statements.STATEMENTS
