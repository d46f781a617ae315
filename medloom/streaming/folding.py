"""Targets that micro-batches write to, kept to a bounded number of files.

Each micro-batch has its folder ``run=<query id>/batch_id=<n>``. A fold reads all complete folders,
combines their rows, writes the result as ``run=folded/batch_id=<n>`` and deletes what it has read.
``combine`` must give the same rows when some of its input is there twice: so neither a fold that
stops between writing and deleting nor a micro-batch that runs again after it was folded changes
what the target says.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from medloom.sources.folders import child_folders, delete_folder, is_complete

FOLDED = "run=folded"
# A micro-batch folds when this many folders have come together.
FOLD_AT = 50


def batch_folders(spark: SparkSession, target: str) -> list[str]:
    """The complete ``run=.../batch_id=...`` folders of a target, names below it."""
    both = [os.path.join(run, b) for run in child_folders(spark, target) for b in child_folders(spark, os.path.join(target, run))]
    return [f for f in both if is_complete(spark, os.path.join(target, f))]


def read_batches(spark: SparkSession, target: str, folders: list[str]) -> DataFrame:
    return spark.read.option("basePath", target).parquet(*[os.path.join(target, f) for f in folders])


def fold(spark: SparkSession, target: str, combine: Callable[[DataFrame], DataFrame]) -> None:
    """Combine all folders of a target into one."""
    folders = batch_folders(spark, target)
    if len(folders) < 2:
        return
    # Names have the form batch_id=<n>, numbers never come again.
    last = max((int(f.rsplit("=", 1)[1]) for f in folders if f.startswith(FOLDED)), default=-1)
    combined = combine(read_batches(spark, target, folders))
    combined.drop("run", "batch_id").write.mode("overwrite").parquet(os.path.join(target, FOLDED, f"batch_id={last + 1}"))
    for folder in folders:
        delete_folder(spark, os.path.join(target, folder))


def fold_when_many(
    spark: SparkSession, target: str, combine: Callable[[DataFrame], DataFrame], at: int = FOLD_AT
) -> None:
    if len(batch_folders(spark, target)) >= at:
        fold(spark, target, combine)
