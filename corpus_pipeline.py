"""From raw documents to packed sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and all that the one before kept; each is written as
Parquet and read again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from longreg.llm import mixing, ngram_join, packing, secret_scan
from longreg.llm.common import packed as as_rows, table
from longreg.llm.queries import WORD_BPE, quality_scores
from longreg.sources.tables import name_shared_folder, stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    scored = quality_scores(as_rows(docs, "doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select("_row.*")


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words, similarity 0.8."""
    return ngram_join.one_of_each(docs, n=5, num=80, den=100)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; all documents stay."""
    return secret_scan.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.apply_mix(docs, mixing.mix_documents(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their places in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(WORD_BPE))


STAGES = [("quality classifier", good_quality), ("n-gram Jaccard join", one_of_similar), ("secret scans", without_secrets),
          ("mixing sources to target weights", mixed), ("best-fit packing", packed)]

#: Learning, sampling and packing can't be expressed in SQL; tests hold the operators against brute force, and run() against its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    name_shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
