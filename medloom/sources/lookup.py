"""Raw tables that look-ups and searches read a few files of.

Documents are written in ranges of their main key, so one key lies in few files. Beside them two
small tables say what a file can hold: ``files`` has the least and greatest value of each indexed
field, ``blooms`` a Bloom filter of the keys that are asked for as a whole. A look-up first picks
the files, then scans these alone with the same filter as before, so its rows are those of a full
scan.

A filter is cut into blocks of 32,768 bits; all bits of a key lie in one block, and ``blooms`` is
sorted by block, so a look-up reads one block per file. A batch of documents is visible once its
rows in ``files`` are written; these are written last, and a batch that is written again replaces
what an interrupted attempt left.
"""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.functions.documents import path

ROWS_PER_FILE = 200_000
BLOCK_BITS = 32_768
BITS_PER_KEY = 12
PROBES = 3
# No character sorts after this one.
_LAST = "\U0010ffff"
_MARK = "Patient/"


def patient_key(reference: Column) -> Column:
    """What follows ``Patient/`` in a reference; null without it."""
    at = F.locate(_MARK, reference)
    return F.when(at > 0, F.substring(reference, at + len(_MARK), F.length(reference)))


def fields_of(resource: str) -> dict[str, Column]:
    """Indexed fields of a raw table; the documents are ordered by the first one."""
    subject = patient_key(path(".subject.reference"))
    return {
        "patients": {"id": path(".id")},
        "encounters": {"patient": subject, "id": path(".id"), "date": path(".period.start")},
        "observations": {"patient": subject, "id": path(".id"), "date": path(".effectiveDateTime")},
    }[resource]


# Fields that are asked for as a whole.
WHOLE = ("id", "patient")


@dataclass(frozen=True)
class LookupTable:
    """A raw table in ``folder`` with its side tables; open one that is there by naming it."""

    spark: SparkSession
    folder: str
    resource: str
    rows_per_file: int = ROWS_PER_FILE

    def _at(self, part: str, batch: str = "*") -> str:
        return os.path.join(self.folder, part, batch)

    def add(self, raw: DataFrame, batch: str) -> None:
        """Write a batch of documents and index its files. Null keys are kept and never found."""
        fields = fields_of(self.resource)
        first = list(fields)[:2]
        order = [F.col(f"_key_{name}") for name in first]
        # No other field goes through the shuffle a second time.
        keyed = raw.select(*raw.columns, *[fields[name].alias(f"_key_{name}") for name in first])
        # The id comes second, so documents of one patient with very many of them are split too.
        # A range is sorted in a task's memory: as many more as there are files to fill.
        ranges = -(-raw.count() // self.rows_per_file)
        more = [ranges] if ranges > int(self.spark.conf.get("spark.sql.shuffle.partitions")) else []
        ranged = keyed.repartitionByRange(*more, *order).sortWithinPartitions(*order)
        data = self._at("data", batch)
        writer = ranged.select(*raw.columns).write.mode("overwrite")
        writer.option("maxRecordsPerFile", self.rows_per_file).option("compression", "zstd").parquet(data)
        keys = self.spark.read.parquet(data).select(
            F.lit(batch).alias("batch"),
            F.substring_index(F.col("_metadata.file_path"), "/", -1).alias("file"),
            *[c.alias(name) for name, c in fields.items()],
        )
        self._blooms(keys).write.mode("overwrite").parquet(self._at("blooms", batch))
        ends = [f(name).alias(f"{name}_{f.__name__}") for name in fields for f in (F.min, F.max)]
        # A reference that names two patients can match by the second one.
        twice = F.count_if(F.col("patient").contains(_MARK)) if "patient" in fields else F.lit(0)
        summed = keys.groupBy("batch", "file").agg(F.count("*").alias("rows"), *ends, twice.alias("irregular"))
        summed.coalesce(1).write.mode("overwrite").parquet(self._at("files", batch))

    def _blooms(self, keys: DataFrame) -> DataFrame:
        """``field, block, batch, file, bits``: a bitmap per block that has a key."""
        whole = [name for name in WHOLE if name in keys.columns]
        fields = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("key")) for n in whole]))
        each = keys.select("batch", "file", fields.alias("f")).select("batch", "file", "f.*").where("key IS NOT NULL")
        # A patient has many documents in a file.
        single = each.select("batch", "file", "field", self._block(F.col("key")).alias("block"), *_places(F.col("key")))
        places = F.explode(F.array(*[F.col(f"place_{k}") for k in range(PROBES)]))
        order = ["field", "block", "batch", "file"]
        bits = single.distinct().select(*order, places.alias("place"))
        built = bits.groupBy(*order).agg(F.bitmap_construct_agg("place").alias("bits"))
        return built.repartitionByRange(*order).sortWithinPartitions(*order)

    def _block(self, key: Column) -> Column:
        blocks = -(-self.rows_per_file * BITS_PER_KEY // BLOCK_BITS)
        return F.pmod(F.xxhash64(key), F.lit(blocks))

    def candidates(self, params: Mapping[str, str], exact_patient: bool = False) -> DataFrame:
        """``batch, file`` of the files that can hold a match of ``id``, ``patient`` or ``date``;
        other parameters do not choose files."""
        files = self.spark.read.parquet(self._at("files"))
        indexed = fields_of(self.resource)
        for name in ("id", "patient", "date"):
            value = params.get(name)
            if not value or name not in indexed:
                continue
            low, high = F.col(f"{name}_min"), F.col(f"{name}_max")
            if name == "id" or (name == "patient" and exact_patient):
                files = files.where((low <= value) & (high >= value))
                files = files.join(self._holding(name, value), ["batch", "file"], "left_semi")
            else:
                # Up to the first wildcard the value is a plain beginning.
                start = re.split("[%_\\\\]", value)[0]
                inside = (low <= start + _LAST) & (high >= start)
                files = files.where(inside | (F.col("irregular") > 0) if name == "patient" else inside)
        return files.select("batch", "file")

    def _holding(self, field: str, value: str) -> DataFrame:
        blooms = self.spark.read.parquet(self._at("blooms"))
        key = F.lit(value)
        own = blooms.where((F.col("field") == field) & (F.col("block") == self._block(key)))
        return own.where(reduce(Column.__and__, [_is_set(F.col("bits"), p) for p in _places(key)]))

    def paths(self, params: Mapping[str, str], exact_patient: bool = False) -> list[str]:
        """The files to scan, at most one name per file of the table."""
        found = self.candidates(params, exact_patient).collect()
        return sorted(os.path.join(self._at("data", r["batch"]), r["file"]) for r in found)

    def pruned(self, params: Mapping[str, str], exact_patient: bool = False) -> DataFrame:
        """The documents of the files that can hold a match."""
        paths = self.paths(params, exact_patient)
        if not paths:
            return self.documents().where(F.lit(False))
        return self.spark.read.parquet(*paths)

    def documents(self) -> DataFrame:
        """All documents of the batches that are visible."""
        files = self.spark.read.parquet(self._at("files"))
        batches = sorted(r["batch"] for r in files.select("batch").distinct().collect())
        return self.spark.read.parquet(*[self._at("data", b) for b in batches])


def _places(key: Column) -> list[Column]:
    hashed = [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(BLOCK_BITS)) for k in range(PROBES)]
    return [place.alias(f"place_{k}") for k, place in enumerate(hashed)]


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.floor(value / F.pow(F.lit(2), place % 8)) % 2 == 1
