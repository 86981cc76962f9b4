"""The queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe_trie, content_sort, decontaminate, fm_toxicity, gru_lm, langid, line_runs, secret_scan, simhash, token_cache


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(documents(spark, sf_dir))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(documents(spark, sf_dir))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.document_log_probs(documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.exact_groups(documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_cache.token_counts(documents(spark, sf_dir))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_trie.encoding_digests(documents(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.line_report(documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_secret_scan": op2_secret_scan,
    "op3_lm_scores": op3_lm_scores,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_bpe": op6_bpe,
    "op7_toxicity": op7_toxicity,
    "op8_decontamination": op8_decontamination,
    "op9_line_dedup": op9_line_dedup,
    "op10_language_id": op10_language_id,
}

ORACLES: dict[str, str] = {"op4_exact_dedup": content_sort.ORACLE, "op9_line_dedup": line_runs.ORACLE}
