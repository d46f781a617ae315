"""A table with one row per key, merged with new rows at the cost of what these touch.

Rows lie in buckets by a hash of their key. A merge reads and rewrites the buckets that the incoming
keys fall into; a manifest names, for each bucket, the version that holds it, so all other buckets
stay where they are. The manifest of a version is written last: until then readers see the version
before, and a merge that stopped runs again from it.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.operators.lineage import merge_first_seen
from medloom.session import scratch_dir
from medloom.sources.folders import child_folders, is_complete

BUCKETS = 256


@dataclass(frozen=True)
class History:
    """The table in ``folder``; name the same keys and number of buckets each time."""

    spark: SparkSession
    folder: str
    keys: Sequence[str]
    buckets: int = BUCKETS

    def _at(self, part: str, version: int) -> str:
        return os.path.join(self.folder, part, f"version={version}")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def version(self) -> int | None:
        """The last version that is complete; None before the first."""
        names = child_folders(self.spark, os.path.join(self.folder, "manifest"))
        numbers = [int(n.split("=")[1]) for n in names]
        return max((v for v in numbers if is_complete(self.spark, self._at("manifest", v))), default=None)

    def _places(self) -> dict[int, int]:
        """Bucket -> version that holds it; at most as many as there are buckets."""
        version = self.version()
        if version is None:
            return {}
        rows = self.spark.read.parquet(self._at("manifest", version)).collect()
        return {r["bucket"]: r["held_by"] for r in rows}

    def _paths(self, places: dict[int, int]) -> list[str]:
        return [os.path.join(self._at("data", v), f"bucket={b}") for b, v in sorted(places.items())]

    def read(self) -> DataFrame:
        """All rows; an error before the first merge."""
        return self.spark.read.parquet(*self._paths(self._places()))

    def merge(self, incoming: DataFrame) -> list[int]:
        """Merge new rows as ``merge_first_seen`` does; returns the buckets that were rewritten.

        Two incoming rows of one key are an error, and nothing is written. Null keys are keys like
        any other. The first merge makes the table.
        """
        target = scratch_dir(self.spark, "incoming")
        incoming.withColumn("bucket", self._bucket()).write.parquet(target)
        new = self.spark.read.parquet(target)
        twice = new.groupBy(*self.keys).count().where("count > 1").first()
        if twice is not None:
            raise ValueError(f"more than one incoming row for a key: {twice.asDict()}")
        touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())
        places = self._places()
        held = {b: places[b] for b in touched if b in places}
        rows = new.drop("bucket")
        if held:
            rows = merge_first_seen(self.spark.read.parquet(*self._paths(held)), rows, self.keys)
        version = self.version()
        version = 0 if version is None else version + 1
        bucketed = rows.withColumn("bucket", self._bucket()).hint("rebalance", "bucket")
        bucketed.write.mode("overwrite").partitionBy("bucket").parquet(self._at("data", version))
        manifest = places | {b: version for b in touched}
        listed = self.spark.createDataFrame(sorted(manifest.items()), "bucket int, held_by int")
        listed.coalesce(1).write.mode("overwrite").parquet(self._at("manifest", version))
        return touched
