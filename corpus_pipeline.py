"""A pipeline of five stages over the documents; each stage reads all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.llm import line_dedup, near_duplicates, packing, quality_classifier, suffix_dedup
from medloom.llm._common import table, written

# The columns that a stage makes anew; all others come along.
MADE = ("doc_id", "text", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Null and empty texts are scored like any other,
    repeated rows each on their own; no documents give none."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents hold go, but for one document each.

    A null text becomes an empty one; rows that repeat an id count as one document; a null id is
    smaller than any other. No row goes; no documents give none.
    """
    kept = line_dedup.dedup_lines(docs, line_dedup.LineIndex.build(docs), carry=_carried(docs))
    return _documents(kept, docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (SimHash of three words, within three bits) one row stays.

    It has the smallest id; null ids come last; of repeated rows one stays. Null, empty and blank
    texts are one group. No documents give none.
    """
    return near_duplicates.keep_one(docs)


def strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings that start in two places go, and what is cut of a character with them.

    A null text becomes an empty one; repeated rows lose the strings that they share. No row goes;
    no documents give none.
    """
    kept = suffix_dedup.dedup_strings(docs, carry=_carried(docs), as_text=True).withColumnRenamed("kept", "text")
    return _documents(kept, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left becomes token sequences. A null text is an empty one; each row is a document of
    its own; no documents give no pieces."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def _carried(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in MADE]


def _documents(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, in their order."""
    made = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return kept.select(*[(made[c] if c in made else F.col("carried").getField(c)).alias(c) for c in docs.columns])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near),
    ("suffix-array dedup", strings),
    ("packing", pack),
]

# Hashed statistics, fingerprints and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
