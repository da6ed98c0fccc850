"""From raw documents to packed training sequences.

Five stages, each an operator of ``ordersmith.llm``: reject bad texts, reject
toxic texts, keep one of each near-duplicate group, mix sources to target
weights, pack into sequences.  A stage takes all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordersmith.llm import jaccard, mixing, packing, toxicity, weak_labels
from ordersmith.llm.common import ready, table, written
from ordersmith.llm.queries import tokenizer_path

#: The pipeline takes nine tenths of the tokens that are left, no text twice.
MIX = mixing.Mix(weights=mixing.PRODUCTION.weights, share=0.9, epochs=1)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return weak_labels.keep_good(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return jaccard.one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return mixing.keep_mixed(docs, MIX)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality", quality), ("toxicity", toxic), ("near_duplicates", near_duplicates), ("mixture", mixture), ("packing", pack)]

#: SQL cannot express the trained stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
