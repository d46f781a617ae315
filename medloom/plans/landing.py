"""Raw tables landed once per session and input, then shared by all queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.operators.validation import validate_ndjson
from medloom.plans import fixtures
from medloom.session import configure, scratch_dir
from medloom.sources.lookup import LookupTable
from medloom.sources.readers import DEFAULT_NAME_PATTERN, read_ndjson_lines
from medloom.sources.writers import LINES_PER_FILE, write_bucketed, write_raw_table

_DOCUMENTS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "patients": fixtures.patient_documents,
    "encounters": fixtures.encounter_documents,
    "observations": fixtures.observation_documents,
}
_landed: dict[tuple[str, str, str], str] = {}


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``record_content, ingestion_time, source_file, source_file_row_number``.

    The documents go the way of uploads: NDJSON files, some of their lines broken, are read,
    numbered and checked, and the valid lines land. Written as shredded VARIANT Parquet, so a
    query reads only the document paths it uses and filters on paths reach the scan.
    """
    configure(spark)

    def land(target: str) -> None:
        uploads = scratch_dir(spark, "uploads")
        lines = fixtures.uploaded_lines(_DOCUMENTS[name](spark, sf_dir))
        # As text the documents take many times the room of the tables they are made of.
        writer = lines.write.option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE)
        # Of half the time of the usual level, for a quarter more room.
        writer = writer.option("zlib.compress.level", "THREE")
        writer.text(f"{uploads}/{name}.ndjson")
        pattern = DEFAULT_NAME_PATTERN.format(resource=name)
        checked = validate_ndjson(read_ndjson_lines(spark, uploads, pattern))
        raw = checked.where("error IS NULL").select(
            "record_content",
            F.lit(fixtures.INGESTED_AT).cast("timestamp").alias("ingestion_time"),
            # The parts of an upload lie in a folder of its name.
            F.substring_index(F.substring_index("source_file", "/", -2), "/", 1).alias("source_file"),
            "source_file_row_number",
        )
        write_raw_table(raw, target)

    return spark.read.parquet(_once(spark, sf_dir, name, land))


def lookup_table(spark: SparkSession, sf_dir: str, name: str) -> LookupTable:
    """The raw table in ranges of its keys, with the tables that pick files for a look-up."""

    def land(target: str) -> None:
        LookupTable(spark, target, name).add(raw_table(spark, sf_dir, name), "first")

    return LookupTable(spark, _once(spark, sf_dir, f"{name}-lookup", land), name)


# Buckets of the co-located tables, and more where one would hold more rows than a task sorts in memory.
BUCKETS = 16
ROWS_PER_BUCKET = 500_000


def buckets_for(*tables: DataFrame) -> int:
    """One number for tables that are to meet."""
    return max(BUCKETS, *(-(-t.count() // ROWS_PER_BUCKET) for t in tables))


def bucketed_table(
    spark: SparkSession, sf_dir: str, name: str, df: DataFrame, key: str, buckets: int = BUCKETS
) -> DataFrame:
    """A staged table in buckets of its key, written once."""

    def land(target: str) -> None:
        write_bucketed(df, "bucketed_" + target.rsplit("-", 1)[-1], key, buckets, target)

    target = _once(spark, sf_dir, f"{name}-bucketed", land)
    return spark.table("bucketed_" + target.rsplit("-", 1)[-1])


def _once(spark: SparkSession, sf_dir: str, name: str, land: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _landed:
        target = scratch_dir(spark, name)
        land(target)
        _landed[key] = target
    return _landed[key]


def ndjson_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder of uploaded NDJSON files with defects, lines in the order of their key."""

    def land(target: str) -> None:
        name = F.format_string("patients_%d.ndjson", "file_no")
        (
            fixtures.ndjson_lines(spark, sf_dir)
            .withColumn("file", name)
            .repartition("file")
            # Starts with the folder column, so the writer does not sort again.
            .sortWithinPartitions("file", "c_custkey")
            .select("value", "file")
            .write.partitionBy("file")
            .text(target)
        )

    return _once(spark, sf_dir, "ndjson", land)
