"""The queries of this subpackage: one operator each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.llm import (
    byte_bpe,
    exact_topk,
    importance,
    line_dedup,
    lm_scoring,
    near_duplicates,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    toxicity,
    warc,
)
from medloom.llm._common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(spark, table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = F.col("vec_id") % exact_topk.QUERY_EVERY == 0
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), every)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every whole text; nulls, repeats and empty tables as in ``periodic_runs.periodic_runs``."""
    return periodic_runs.digests(table(spark, sf_dir, "documents"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages archived and read back; nulls and repeats as in ``warc.Archive.of_pages``."""
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents drawn towards the benchmark texts; nulls, repeats and empty tables as in
    ``importance.resample``."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_packing": op3_packing,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_toxicity": op6_toxicity,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_quality_rules": op8_quality_rules,
    "op9_exact_topk": op9_exact_topk,
    "op10_simhash": op10_simhash,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_warc": op12_warc,
    "op13_importance_resampling": op13_importance_resampling,
}

SQL = {
    "op1_line_dedup": line_dedup.SQL,
    "op8_quality_rules": quality_rules.SQL,
    "op9_exact_topk": exact_topk.SQL,
    "op12_warc": warc.SQL,
    "op13_importance_resampling": importance.SQL,
}
