"""A ledger of loaded files, shared by all queries and checkpoints that load a target.

A file is known by path, size and time of change. A micro-batch takes the files that no other batch
has in the ledger, writes its rows and then enters its files: the entry makes the batch's rows part
of the target (``loaded_folders``). A batch whose entry is missing has loaded nothing, whatever an
interrupted attempt left in its folder; it runs again, or another query takes its files. One query
at a time loads a target.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.streaming.folding import FOLD_AT, batch_folders, fold_when_many, read_batches

IDENTITY = ("path", "length", "modificationTime")
ENTRY = "path string, length bigint, modificationTime timestamp, part string"


@dataclass(frozen=True)
class LoadLedger:
    """Entries lie under ``folder``, by query and batch, and are folded now and then."""

    spark: SparkSession
    folder: str
    fold_at: int = FOLD_AT

    def entries(self) -> DataFrame:
        """``path, length, modificationTime, part``; an entry may be there twice."""
        folders = batch_folders(self.spark, self.folder)
        if not folders:
            return self.spark.createDataFrame([], ENTRY)
        columns = [c.split()[0] for c in ENTRY.split(", ")]
        return read_batches(self.spark, self.folder, folders).select(*columns)

    def unseen(self, files: DataFrame, part: str) -> DataFrame:
        """The files that no other batch has loaded. ``files`` is one micro-batch: bounded."""
        batch = files.select(*IDENTITY).distinct()
        ends = batch.agg(F.min("path").alias("low"), F.max("path").alias("high")).first()
        if ends.low is None:
            return batch
        # Entries are sorted by path: of a long ledger only what lies near these files is read.
        near = self.entries().where(F.col("path").between(ends.low, ends.high) & (F.col("part") != part))
        known = near.join(F.broadcast(batch), list(IDENTITY), "left_semi").select(*IDENTITY)
        return batch.join(known, list(IDENTITY), "left_anti")

    def enter(self, files: DataFrame, part: str) -> None:
        """Write the files of a batch as loaded; again and again gives the same."""
        entries = files.select(*IDENTITY, F.lit(part).alias("part")).coalesce(1).sortWithinPartitions("path")
        entries.write.mode("overwrite").parquet(os.path.join(self.folder, part))
        fold_when_many(self.spark, self.folder, _once, self.fold_at)

    def parts(self) -> list[str]:
        """Batches that have loaded files: as many names as folders of the target."""
        return sorted(r["part"] for r in self.entries().select("part").distinct().collect())


def _once(entries: DataFrame) -> DataFrame:
    return entries.drop("run", "batch_id").distinct().repartitionByRange("path").sortWithinPartitions("path")


def read_loaded(spark: SparkSession, table: str, ledger: str) -> DataFrame:
    """The rows of a target whose files are in its ledger."""
    parts = LoadLedger(spark, ledger).parts()
    return spark.read.option("basePath", table).parquet(*[os.path.join(table, p) for p in parts])
