"""Training-data pipeline over the ``documents`` table.

Five stages, each an operator of ``marketlens.llm``: quality rules, quality
classifier, near-duplicates, repeated passages, packing.  Every stage is written
as Parquet under spark.checkpoint.dir and read again as the input of the next,
so that a lost executor costs no more than the stage in work.  All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marketlens.llm import line_rules, order_minhash, packing, quality_trees, suffix_dedup
from marketlens.llm.common import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return line_rules.kept_documents(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among its
    input, takes for good."""
    return quality_trees.kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, the one with the smallest doc_id."""
    return order_minhash.kept_documents(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that also start earlier."""
    return suffix_dedup.cleaned_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in the sequences."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packed_sequences", packed_sequences),
]

#: Boosted trees and alignments are out of reach of SQL; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
