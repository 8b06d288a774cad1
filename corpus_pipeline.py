"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from subledger.llm import jaccard_join, mixing, quality_rules, toxicity
from subledger.llm.queries import packed, table
from subledger.session import materialized

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words and compression are those of prose; the others go."""
    return quality_rules.keep_good(docs)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents no sentence of which scores as toxic; the labels of those that came here are learned from."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    return jaccard_join.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    return mixing.mixed_documents(docs)


def in_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, and the sequence and offset of each."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", good_quality),
    ("toxicity", not_toxic),
    ("ngram_jaccard_join", one_of_each),
    ("source_mixing", mixed),
    ("best_fit_packing", in_sequences),
]

#: The stages learn, hash and pack, which SQL cannot say; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if at == 0 else materialized(docs), sf_dir)
    return docs
