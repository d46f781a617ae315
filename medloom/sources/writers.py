"""Writers: DataFrames -> files and tables.

Layouts by type, day or year go through a ``rebalance`` hint: rows of one folder meet in few
tasks (no task x day flood of small files), while a folder holding a large share of all rows
is split over several tasks at run time.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from medloom.functions.documents import path
from medloom.schemas import OMOP_PARTITIONS


# Lines of a compressed text file, at most.
LINES_PER_FILE = 50_000


def write_raw_table(raw: DataFrame, target: str, mode: str = "append") -> None:
    """Raw documents as shredded VARIANT Parquet, so later scans read single paths."""
    writer = raw.write.mode(mode).option("compression", "zstd")
    # Histograms of levels, kept for each value of some hundred columns; no reader here uses them.
    writer.option("parquet.size.statistics.enabled", "false").parquet(target)


def write_flat_parquet(df: DataFrame, target: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(target)


def write_ndjson(
    df: DataFrame, target: str, text: str = "value", file: str = "source_file", mode: str = "append"
) -> None:
    """Document text to NDJSON; the original file name stays as a folder name.

    Known row numbers keep the lines of a file in order within each part.
    """
    named = df.withColumn("file", F.element_at(F.split(F.col(file), "/"), -1))
    order = [c for c in ("file", "source_file_row_number") if c in named.columns]
    named.sortWithinPartitions(*order).select(F.col(text).alias("value"), "file").write.mode(
        mode
    ).partitionBy("file").text(target)


def bundles_of(df: DataFrame, text: str, size: int) -> DataFrame:
    """Collection Bundles of at most ``size`` resources, cut inside each task.

    The functions are nested so that they travel with the task: workers need not have this
    package installed.
    """

    def rows(resources: list[str]) -> pd.DataFrame:
        bundles = []
        for start in range(0, len(resources), size):
            entries = ",".join(f'{{"resource":{r}}}' for r in resources[start : start + size])
            bundles.append(f'{{"resourceType":"Bundle","type":"collection","entry":[{entries}]}}')
        return pd.DataFrame({"value": pd.Series(bundles, dtype="object")})

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[str] = []
        for batch in batches:
            held.extend(batch[text])
            full = len(held) - len(held) % size
            yield rows(held[:full])
            held = held[full:]
        yield rows(held)

    return df.select(text).mapInPandas(pack, "value string")


def write_bundle(df: DataFrame, target: str, text: str = "value", size: int = 10_000) -> None:
    """Resources -> collection Bundles, one Bundle per file and ``size`` resources at most."""
    bundles_of(df, text, size).write.option("maxRecordsPerFile", 1).mode("overwrite").text(target)


def write_by_type_and_date(
    df: DataFrame, types: Sequence[str], target: str, day: Column, doc: str = "record_content"
) -> DataFrame:
    """Resources of the wanted types as gzipped NDJSON per type and day; returns counts per type.

    Types without resources get neither a folder nor a count.
    """
    kept = df.select(
        F.to_json(doc).alias("value"),
        path(".resourceType", doc=doc).alias("resource_type"),
        day.alias("date"),
    ).filter(F.col("resource_type").isin(*types))
    # Counted while they are written.
    seen = Observation()
    counted = kept.observe(seen, *[F.count_if(F.col("resource_type") == t).alias(t) for t in types])
    writer = counted.hint("rebalance", "resource_type", "date").write.mode("overwrite")
    # A compressed file is one task of a later read.
    writer = writer.option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE)
    writer.partitionBy("resource_type", "date").text(target)
    counts = [(t, n) for t, n in seen.get.items() if n]
    return df.sparkSession.createDataFrame(counts, "resource_type string, record_count bigint")


def write_date_partitioned(df: DataFrame, ts: str, target: str, mode: str = "append") -> None:
    """Rows under ``year=/month=/day=`` of a timestamp, as JSON lines."""
    days = {"year": "yyyy", "month": "MM", "day": "dd"}
    dated = df.withColumns({name: F.date_format(ts, fmt) for name, fmt in days.items()})
    dated.hint("rebalance", *days).write.mode(mode).partitionBy(*days).json(target)


def write_omop_partitioned(df: DataFrame, table: str, target: str) -> None:
    """Person by year of birth, conditions and measurements by event day."""
    column = OMOP_PARTITIONS[table]
    df.hint("rebalance", column).write.mode("overwrite").partitionBy(column).parquet(target)


def write_run_scoped(df: DataFrame, root: str, run_id: str, zone: str) -> str:
    """Output of one pipeline run under ``runs/<run id>/<zone>``."""
    target = os.path.join(root, "runs", f"pipeline_run_id={run_id}", zone)
    df.write.mode("overwrite").parquet(target)
    return target


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialize_table(df: DataFrame, name: str, path_: str | None = None) -> DataFrame:
    """Managed table, or a table over ``path_``; replaces an earlier one."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path_) if path_ else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path_: str | None = None) -> DataFrame:
    """Table in hash buckets of a key, each sorted by it; replaces an earlier one.

    Tables with the same number of buckets join on the key without a shuffle, as often as they are
    used. A key must not hold a large share of the rows: its bucket is one task of the join.
    """
    # One task writes a bucket, so there is one file for each.
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path_) if path_ else writer).saveAsTable(name)
    return df.sparkSession.table(name)
