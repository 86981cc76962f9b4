"""A corpus pipeline of five operators, each on what the one before kept.

Stages take (spark, docs, sf_dir); all but the last return the columns of documents. Duplicates of ids
and null ids are kept apart by row; see each operator's module for odd input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievestone.llm import bpe_trie, common, decontaminate, fm_toxicity, line_runs, simhash


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at or above the threshold go."""
    return fm_toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents go; every document stays, if with less text."""
    return line_runs.without_lines(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays: five-word SimHash by the generalised pigeonhole,
    buckets for what lies beyond its radius, and a similarity of 0.8 or more of the shingles themselves."""
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text."""
    return bpe_trie.encoding_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", keep_one_of_near_copies),
    ("decontamination", drop_benchmark),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = common.save(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            common.drop(before)  # nothing reads it any more
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)


#: A trained model decides in the first stage.
ORACLE_SQL = None
