"""Search for a part of a text without reading all texts.

Every run of three characters of a text, lower-cased, is a key of a posting list of ids. A search
takes the rarest keys of its pattern, keeps the ids that are in all of their lists, and verifies
only these. Patterns without three plain characters in a row are searched by a scan.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3
# Posting lists that are met, the shortest ones of a pattern's.
LISTS = 4
# Up to this many candidates go into the scan as a list of ids, which can skip row groups.
LISTED_IDS = 1000


def grams(text: Column) -> Column:
    """The distinct runs of three characters; none for shorter texts and null."""
    last = F.length(text) - GRAM + 1
    runs = F.transform(F.sequence(F.lit(1), last), lambda at: F.substring(text, at, F.lit(GRAM)))
    return F.when(last >= 1, F.array_distinct(runs))


@dataclass(frozen=True)
class SubstringIndex:
    """Posting lists of one text column under ``folder``."""

    spark: SparkSession
    folder: str

    def _at(self, part: str) -> str:
        return os.path.join(self.folder, part)

    def build(self, df: DataFrame, id_: str, text: str) -> None:
        """Index all rows; replaces what is there. Null ids and texts are not found by any search."""
        each = df.select(F.col(id_).cast("string").alias("id"), F.explode(grams(F.lower(text))).alias("gram"))
        # A list that most rows are in lies in many tasks and files: ids are part of the order.
        ordered = each.distinct().repartitionByRange("gram", "id").sortWithinPartitions("gram", "id")
        ordered.write.mode("overwrite").parquet(self._at("postings"))
        lists = self.spark.read.parquet(self._at("postings")).groupBy("gram").agg(F.count("*").alias("n"))
        lists.sort("gram").write.mode("overwrite").parquet(self._at("lists"))

    def candidates(self, pattern: str) -> DataFrame | None:
        """``id`` of the rows whose text can hold the pattern (``%`` and ``_`` are wildcards as in
        LIKE); None if the pattern has no key."""
        wanted = set()
        for plain in re.split("[%_]", pattern):
            # Lower-cased by Spark, as the texts were.
            low = self.spark.range(1).select(F.lower(F.lit(plain))).first()[0]
            wanted |= {low[k : k + GRAM] for k in range(len(low) - GRAM + 1)}
        if not wanted:
            return None
        lists = self.spark.read.parquet(self._at("lists")).where(F.col("gram").isin(sorted(wanted)))
        sizes = {r["gram"]: r["n"] for r in lists.collect()}  # at most as many as the pattern has
        postings = self.spark.read.parquet(self._at("postings"))
        if len(sizes) < len(wanted):
            return postings.where(F.lit(False)).select("id")
        chosen = sorted(wanted, key=lambda g: (sizes[g], g))[:LISTS]
        met = postings.where(F.col("gram").isin(chosen)).groupBy("id").agg(F.count("*").alias("n"))
        return met.where(F.col("n") == len(chosen)).select("id")

    def narrowed(self, df: DataFrame, id_: str, pattern: str) -> DataFrame:
        """The rows that can match; the search itself must still be applied to them."""
        found = self.candidates(pattern)
        if found is None:
            return df
        few = [r["id"] for r in found.limit(LISTED_IDS + 1).collect()]
        key = F.col(id_).cast("string") if dict(df.dtypes)[id_] != "string" else F.col(id_)
        if len(few) <= LISTED_IDS:
            return df.where(key.isin(few)) if few else df.where(F.lit(False))
        return df.join(found.withColumnRenamed("id", "_candidate"), key == F.col("_candidate"), "left_semi")
