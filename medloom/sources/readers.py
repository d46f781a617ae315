"""Readers: landed files -> DataFrames."""

from __future__ import annotations

import os
import re
from collections.abc import Collection, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from medloom.functions.documents import is_blank, path, with_document
from medloom.schemas import OMOP_SCHEMAS
from medloom.session import sized
from medloom.sources.csv import csv_records

# A file of this name, or the parts of a folder of this name (as ``write_ndjson`` makes them).
# Asked of every line: few steps from the left, none back from the end.
DEFAULT_NAME_PATTERN = r".*?{resource}.*?\.ndjson(/[^/]*)?"

_SPLIT = ["source_file", "_split_start"]

# Up to this many splits their line counts are broadcast (some tens of MB).
BROADCAST_SPLITS = 250_000


def read_ndjson_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    name_pattern: str | None = None,
    numbered: bool = True,
) -> DataFrame:
    """Lines of NDJSON files: ``value, source_file, ingestion_time, source_file_row_number``.

    Files stay splittable: a row number is the position inside its split plus the line
    counts of the earlier splits of the same file, so one huge file is still read by many
    tasks. ``numbered=False`` leaves the number null and saves the counting pass.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        # Both passes over the files must cut them alike, however many cores are up.
        spark.conf.set(
            "spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism)
        )
    text = (
        spark.read.option("lineSep", "\n")
        .option("recursiveFileLookup", "true")
        .text(list(paths) if not isinstance(paths, str) else paths)
    )
    lines = text.select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("_split_start"),
        F.col("_metadata.file_modification_time").alias("ingestion_time"),
    )
    if name_pattern:
        lines = lines.filter(F.col("source_file").rlike(f"^{name_pattern}$"))
    if not numbered:
        return lines.drop("_split_start").withColumn(
            "source_file_row_number", F.lit(None).cast("bigint")
        )
    return number_lines(lines)


def number_lines(lines: DataFrame) -> DataFrame:
    """Add ``source_file_row_number`` (1-based) and ``first_text_row`` of the file.

    ``first_text_row`` is the number of the first line that is not blank. The line counts
    per split are computed at once and kept in the scratch folder; the lines themselves are
    not shuffled unless there are more than ``BROADCAST_SPLITS`` splits.
    """
    placed = lines.withColumn("_at", F.monotonically_increasing_id())
    splits = placed.groupBy(*_SPLIT).agg(
        F.count(F.lit(1)).alias("_lines"),
        F.min("_at").alias("_first_at"),
        F.min(F.when(~is_blank("value"), F.col("_at"))).alias("_text_at"),
    )
    # One row per split from here on, so this window never sees the lines themselves.
    earlier = (
        W.Window.partitionBy("source_file")
        .orderBy("_split_start")
        .rowsBetween(W.Window.unboundedPreceding, -1)
    )
    whole = W.Window.partitionBy("source_file")
    offsets = (
        splits.withColumn("_before", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)))
        .withColumn(
            "first_text_row",
            F.min(F.col("_before") + F.col("_text_at") - F.col("_first_at") + 1).over(whole),
        )
        .select(*_SPLIT, "_lines", "_first_at", "_before", "first_text_row")
    )
    inside = F.col("_at") - F.col("_first_at")
    same_cut = inside.between(F.lit(0), F.col("_lines") - 1)
    number = F.when(same_cut, F.col("_before") + inside + 1).otherwise(
        F.raise_error(F.lit("file splits changed between passes; run again")).cast("bigint")
    )
    return (
        placed.join(sized(offsets, "split-lines", BROADCAST_SPLITS), _SPLIT, "left")
        .withColumn("source_file_row_number", number)
        .drop("_split_start", "_at", "_lines", "_first_at", "_before")
    )


def read_ndjson_raw(
    spark: SparkSession,
    paths: str | Sequence[str],
    resource: str,
    name_pattern: str | None = None,
    numbered: bool = True,
) -> DataFrame:
    """NDJSON files as the raw table; only files whose name matches the resource."""
    pattern = name_pattern or DEFAULT_NAME_PATTERN.format(resource=resource)
    lines = read_ndjson_lines(spark, paths, pattern, numbered).filter(~is_blank("value"))
    return with_document(lines, "value").select(
        "record_content", "ingestion_time", "source_file", "source_file_row_number"
    )


def explode_entries(doc: str | Column) -> Column:
    """One row per ``entry``; no entries means no rows."""
    return F.explode(path(".entry", "array<variant>", doc))


def read_bundle(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Bundle files (one Bundle each) -> one row per contained resource."""
    files = _whole_files(spark, paths)
    entries = files.select(explode_entries(F.try_parse_json("value")).alias("_e"), "source_file")
    return entries.select(path(".resource", "variant", "_e").alias("record_content"), "source_file")


def read_resource_files(spark: SparkSession, folder: str, glob: str = "patient_*.json") -> DataFrame:
    """One JSON resource per file."""
    files = _whole_files(spark, folder, glob)
    return files.select(F.try_parse_json("value").alias("record_content"), "source_file")


def _whole_files(
    spark: SparkSession, paths: str | Sequence[str], glob: str | None = None
) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    text = reader.text(list(paths) if not isinstance(paths, str) else paths, wholetext=True)
    return text.select("value", F.col("_metadata.file_path").alias("source_file"))


# Cells that stand for a missing value, as pandas reads them.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
BROKEN = "_corrupt_record"


@dataclass(frozen=True)
class OmopCsv:
    """An OMOP table as text: ``raw`` has all cells and the broken record, if it is one."""

    raw: DataFrame
    names: list[str]
    types: dict[str, str]

    @classmethod
    def open(cls, spark: SparkSession, path_: str, table: str, multi_line: bool = True) -> OmopCsv:
        dialect = {"escape": '"', "nullValue": "\u0000", "emptyValue": ""}
        dialect |= {"columnNameOfCorruptRecord": BROKEN}
        header = {"header": "true", "multiLine": str(multi_line).lower()}
        names = spark.read.options(**dialect, **header).csv(path_).columns
        # A name is quoted in a schema text; all cells are read as text.
        schema = ", ".join(f"{_quoted(n)} string" for n in [*names, BROKEN])
        if multi_line:
            records = csv_records(spark, path_).where("not header")
            # A generator's output is computed once, however many columns are taken from it.
            parsed = F.from_csv("record", F.lit(schema), {**dialect, "mode": "PERMISSIVE"})
            read = records.select(F.inline(F.array(parsed)))
        else:
            # A record is whole or broken whatever columns are asked for.
            reader = spark.read.options(**dialect, **header, mode="FAILFAST", columnPruning="false")
            read = reader.schema(schema).csv(path_)
        cells = [F.when(~F.col(_quoted(n)).isin(*MISSING), F.col(_quoted(n))).alias(n) for n in names]
        types = OMOP_SCHEMAS.get(table, {})
        return cls(read.select(*cells, BROKEN), names, {n: types[n] for n in names if n in types})

    def unfit(self) -> dict[str, Column]:
        """Counts of values that do not fit their type, and of broken records."""
        counts = {
            n: F.count_if(F.col(_quoted(n)).isNotNull() & _as_type(F.col(_quoted(n)), t).isNull())
            for n, t in self.types.items()
            if t != "string"
        }
        # Spark does not answer for the broken records alone.
        broken = F.col(BROKEN).isNotNull() | F.col(_quoted(self.names[0])).eqNullSafe(BROKEN)
        return counts | {BROKEN: F.count_if(broken)}

    def typed(self, unfit: Collection[str], raw: DataFrame | None = None) -> DataFrame:
        """The table; columns named in ``unfit`` keep their text."""
        columns = [
            _as_type(F.col(_quoted(n)), self.types[n]).alias(n)
            if n in self.types and n not in unfit
            else F.col(_quoted(n)).alias(n)
            for n in self.names
        ]
        return (raw or self.raw).select(*columns)


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def read_omop_csv(
    spark: SparkSession, path_: str, table: str, multi_line: bool = True
) -> tuple[DataFrame, dict[str, int]]:
    """CSV -> typed OMOP table, plus the number of values that did not fit per column.

    Quotes may hold commas, line ends and doubled quotes, and files are split over tasks all the
    same. As in pandas, a column with any unfit value keeps its text, the usual markers are missing
    values, and unknown columns are kept. Records with too many or too few cells are counted under
    ``_corrupt_record``; what they hold is kept. ``multi_line=False`` takes every line for a record,
    which saves a pass, and the read fails on a record that does not fit its header.
    """
    csv = OmopCsv.open(spark, path_, table, multi_line)
    counts = csv.raw.agg(*[c.alias(n) for n, c in csv.unfit().items()]).first().asDict()
    failed = {n: count for n, count in counts.items() if count}
    return csv.typed(failed), failed


def _as_type(text: Column, type_: str) -> Column:
    if type_ == "bigint":
        # A nullable integer column is often exported as 8507.0
        text = F.regexp_replace(text, r"^(-?\d+)\.0+$", "$1")
    return text.try_cast(type_)


# Tables converted side by side.
TABLES_AT_ONCE = 4


def convert_omop_dir(spark: SparkSession, in_dir: str, out_dir: str) -> DataFrame:
    """Every CSV table in a folder to Parquet; one report row per table, errors do not stop it.

    A table is a file ``<table>.csv`` or a folder ``<table>.csv`` of parts. Values that do not fit are
    counted while a table is written; only a table that has any is written again, with the text of
    these columns. Report: ``table, rows, output, unfit_columns, error``.
    """
    below = F.regexp_extract("path", re.escape(in_dir.rstrip("/")) + "/+([^/]+)", 1)
    found = source_manifest(spark, in_dir, "*.csv").select(below.alias("name")).distinct()
    # One name per table, not per file.
    names = sorted(row["name"] for row in found.collect())

    def convert(name: str) -> tuple:
        table = name.removesuffix(".csv")
        target = os.path.join(out_dir, f"{table}.parquet")
        try:
            csv = OmopCsv.open(spark, os.path.join(in_dir, name), table)
            seen = Observation()
            counts = [c.alias(n) for n, c in csv.unfit().items()]
            raw = csv.raw.observe(seen, F.count(F.lit(1)).alias("rows of the table"), *counts)
            csv.typed([], raw).write.mode("overwrite").parquet(target)
            counted = dict(seen.get)
            rows = counted.pop("rows of the table")
            failed = sorted(n for n, count in counted.items() if count)
            if set(failed) - {BROKEN}:
                csv.typed(failed).write.mode("overwrite").parquet(target)
            return table, rows, target, failed, None
        except Exception as error:  # the next table must still be converted
            return table, None, None, [], f"{type(error).__name__}: {error}"

    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        report = list(pool.map(convert, names))
    schema = "table string, rows bigint, output string, unfit_columns array<string>, error string"
    return spark.createDataFrame(report, schema)


def read_parquet_table(
    spark: SparkSession, folder: str, name: str, columns: Sequence[str] | None = None
) -> DataFrame:
    df = spark.read.parquet(os.path.join(folder, f"{name}.parquet"))
    return df.select(*columns) if columns else df


def source_manifest(spark: SparkSession, folder: str, glob: str = "*.json") -> DataFrame:
    """``path, length, modificationTime`` of the available files; an error if none.

    File contents are not read: the column is pruned from the scan. Spark's readers pass over
    empty files, so they are not listed either.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length", "modificationTime")
    )
    if files.isEmpty():
        raise ValueError(f"no files like {glob} in {folder}")
    return files


BINARY_FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
