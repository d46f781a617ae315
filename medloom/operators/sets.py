"""Id sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_difference(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of ``a`` that ``b`` lacks; nulls are equal to each other."""
    return a.select(*columns).subtract(b.select(*columns))


def disjoint_ids(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """One row: how many ids both sides share, and whether there are none."""
    shared = a.select(column).intersect(b.select(column))
    return shared.agg(F.count(column).alias("shared_ids")).withColumn(
        "disjoint", F.col("shared_ids") == 0
    )


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
