"""Lineage columns and first-seen bookkeeping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lineage_columns(
    df: DataFrame,
    ingestion_ts: Column,
    source_origin: Column | str = "unknown",
    pipeline_run_id: Column | str = "unknown",
    first_seen: Column | None = None,
    model: str = "unknown",
    run_id: str = "unknown",
    env: str = "dev",
) -> DataFrame:
    """Add the standard ingestion and provenance columns; ``first_seen`` defaults to now."""

    def col(value: Column | str) -> Column:
        return F.lit(value) if isinstance(value, str) else value

    return df.withColumns(
        {
            "lineage_last_updated_ts": ingestion_ts,
            "lineage_first_seen_ts": ingestion_ts if first_seen is None else first_seen,
            "pipeline_run_id": col(pipeline_run_id),
            "lineage_source_origin": col(source_origin),
            "lineage_run_id": F.lit(run_id),
            "lineage_model": F.lit(model),
            "lineage_env": F.lit(env),
        }
    )


def merge_first_seen(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Re-ingest: earliest first-seen time, newest values.

    Both sides have the same columns and one row per key. A key on one side only is kept.
    """
    old, new = existing.alias("old"), incoming.alias("new")
    condition = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
    arrived = F.col("_arrived").isNotNull()
    columns = []
    for c in existing.columns:
        before, after = F.col(f"old.{c}"), F.col(f"new.{c}")
        if c in keys:
            columns.append(F.coalesce(after, before).alias(c))
        elif c == "lineage_first_seen_ts":
            columns.append(F.least(before, after).alias(c))
        else:
            columns.append(F.when(arrived, after).otherwise(before).alias(c))
    marked = new.withColumn("_arrived", F.lit(True)).alias("new")
    return old.join(marked, condition, "full_outer").select(*columns)


def lineage_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First and last time and the set of sources per key."""
    return df.groupBy(*keys).agg(
        F.min("lineage_first_seen_ts").alias("first_seen"),
        F.max("lineage_last_updated_ts").alias("last_updated"),
        F.sort_array(F.collect_set("lineage_source_origin")).alias("sources"),
    )
