"""A training-data pipeline over ``documents``: each stage works on all that the one before kept.

The last stage's rows are the training sequences.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from allelespark.llm import decontaminate, mixing, simhash, token_shards, toxicity
from allelespark.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.acceptable(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked SimHash fingerprints the smallest doc_id stays."""
    return simhash.survivors(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; each source's last one is cut at the budget."""
    return mixing.mixed(docs)


def write_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences in training order, written as shards and read from them."""
    return token_shards.written(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_output", write_order),
]

#: SQL has neither the trained model, nor XXH64, nor the tokenizer; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
