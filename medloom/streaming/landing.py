"""Landed files as streams.

Each micro-batch is a bounded list of new files, handed to the batch readers and operators,
so stream and batch give the same rows. All outputs of a micro-batch go under the folder of
its query and batch (``run=<query id>/batch_id=<n>``) and replace what an interrupted attempt
left there: a replay after a lost driver or executor writes the same rows once, and another
query, or the same one with a new checkpoint, adds to a target without touching earlier data.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from medloom.functions.documents import path
from medloom.operators.bundles import validate_bundle
from medloom.operators.validation import split_valid_quarantine_files, validate_ndjson
from medloom.session import scratch_dir
from medloom.sources.folders import delete_folder, make_folder
from medloom.sources.readers import BINARY_FILE_SCHEMA, read_ndjson_lines, read_ndjson_raw
from medloom.sources.writers import write_ndjson, write_raw_table
from medloom.streaming.ledger import IDENTITY, LoadLedger

MAX_FILES = 1000
# All there is, then stop. ``{"processingTime": "1 minute"}`` keeps a stream running.
ONCE = {"availableNow": True}


def batch_folder(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """Where a micro-batch writes below a target. The query's id is the checkpoint's own."""
    run = spark.read.json(os.path.join(checkpoint, "metadata")).select("id").first()[0]
    return os.path.join(f"run={run}", f"batch_id={batch_id}")


@contextmanager
def written_for_now(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """The frame as a table in the scratch folder, for several readers; deleted afterwards."""
    spark, target = df.sparkSession, scratch_dir(df.sparkSession, purpose)
    df.write.parquet(target)
    try:
        yield spark.read.schema(df.schema).parquet(target)
    finally:
        delete_folder(spark, target)


REQUEST_SCHEMA = (
    "request_id string, organization_id string, requested_at timestamp_ntz, body string"
)


def _new_files(spark: SparkSession, folder: str, glob: str, max_files: int) -> DataFrame:
    """Paths of arriving files; their contents are not read here."""
    return (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(folder)
        .select(*IDENTITY)
    )


def _for_each_batch_of_files(
    files: DataFrame,
    checkpoint: str,
    trigger: dict,
    handle: Callable[[list[str], str], None],
    ledger: str | None = None,
) -> StreamingQuery:
    """With a ledger, files that another query or checkpoint has loaded are passed over."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        part = batch_folder(spark, checkpoint, batch_id)
        book = LoadLedger(spark, ledger) if ledger else None
        # At most maxFilesPerTrigger files.
        rows = (book.unseen(batch, part) if book else batch).collect()
        if rows:
            handle([row.path for row in rows], part)
            if book:
                book.enter(spark.createDataFrame(rows, batch.schema), part)

    return (
        files.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def stream_validate_landing(
    spark: SparkSession,
    landing: str,
    out: str,
    checkpoint: str,
    glob: str = "*.ndjson",
    max_files: int = MAX_FILES,
    trigger: dict = ONCE,
) -> StreamingQuery:
    """New NDJSON files -> ``processed/``; a file with a bad line -> ``quarantine/``.

    The lines of a micro-batch are parsed and checked once and written; both sides read them there.
    """

    def handle(paths: list[str], part: str) -> None:
        with written_for_now(validate_ndjson(read_ndjson_lines(spark, paths)), "checked") as checked:
            valid, failed = split_valid_quarantine_files(checked)
            write_ndjson(valid, os.path.join(out, "processed", part), mode="overwrite")
            failed.write.mode("overwrite").json(os.path.join(out, "quarantine", part))

    files = _new_files(spark, landing, glob, max_files)
    return _for_each_batch_of_files(files, checkpoint, trigger, handle)


def stream_raw_ingest(
    spark: SparkSession,
    processed: str,
    table: str,
    resource: str,
    checkpoint: str,
    glob: str = "*",
    name_pattern: str | None = None,
    max_files: int = MAX_FILES,
    trigger: dict = ONCE,
    ledger: str | None = None,
) -> StreamingQuery:
    """Processed files into the raw table of their resource.

    A query loads each file once. With a ``ledger`` folder this holds for all queries and checkpoints
    that share it: each file is loaded once, and ``read_loaded`` gives the rows of the table.
    """

    def handle(paths: list[str], part: str) -> None:
        raw = read_ndjson_raw(spark, paths, resource, name_pattern)
        write_raw_table(raw, os.path.join(table, part), mode="overwrite")

    files = _new_files(spark, processed, glob, max_files)
    return _for_each_batch_of_files(files, checkpoint, trigger, handle, ledger)


def bundle_resources(checked: DataFrame) -> DataFrame:
    """Valid checked requests -> their resources with type and place in the bundle."""
    entries = checked.select(
        "request_id",
        "organization_id",
        "requested_at",
        F.posexplode(path(".entry", "array<variant>", "bundle")).alias("entry_position", "_e"),
    )
    return entries.select(
        "request_id",
        "organization_id",
        "requested_at",
        "entry_position",
        path(".resource", "variant", "_e").alias("record_content"),
        F.coalesce(path(".resource.resourceType", doc="_e"), F.lit("Unknown")).alias(
            "resource_type"
        ),
    )


# Fixed value: receives of a request before it is given up.
MAX_RECEIVES = 3


def stream_bundle_ingest(
    spark: SparkSession,
    requests_dir: str,
    out: str,
    checkpoint: str,
    max_files: int = MAX_FILES,
    trigger: dict = ONCE,
    check: Callable[[DataFrame], DataFrame] = validate_bundle,
    max_receives: int = MAX_RECEIVES,
    ledger: str | None = None,
) -> StreamingQuery:
    """Queued bundle requests (JSON lines) -> raw resources per type; rejects apart.

    ``check`` adds ``bundle`` and ``error`` to the requests. A request with an error is received
    again: it goes to ``retry/``, which is a second source of the stream, with its number of
    receives, and with the next trigger it is checked anew. After ``max_receives`` errors it goes to
    ``dead_letter/``. All that a micro-batch writes lies in its own folder and is replaced when the
    batch runs again, so a request is in one place only, whenever a run stops.

    Rows carry ``requested_at`` and ``entry_position`` and are written in that order per
    organization within a task, so the order of an organization can always be restored
    without sending all of its rows to one task. With a ``ledger`` each file of requests is taken
    once by all queries that share it.
    """

    def handle(paths: list[str], part: str) -> None:
        requests = spark.read.schema(f"{REQUEST_SCHEMA}, receives int").json(paths)
        counted = requests.withColumn("receives", F.coalesce("receives", F.lit(0)) + 1)
        with written_for_now(check(counted), "requests") as checked:
            bundle_resources(checked.where("error IS NULL")).sortWithinPartitions(
                "resource_type", "organization_id", "requested_at", "entry_position"
            ).write.mode("overwrite").partitionBy("resource_type").parquet(
                os.path.join(out, "raw", part)
            )
            failed = checked.where("error IS NOT NULL").drop("bundle")
            again = failed.where(F.col("receives") < max_receives).drop("error")
            again.write.mode("overwrite").json(os.path.join(out, RETRY, part))
            dead = failed.where(F.col("receives") >= max_receives)
            dead.write.mode("overwrite").json(os.path.join(out, "dead_letter", part))

    retry = os.path.join(out, RETRY)
    make_folder(spark, retry)
    files = _new_files(spark, requests_dir, "*.json", max_files)
    files = files.unionAll(_new_files(spark, retry, "*.json", max_files))
    return _for_each_batch_of_files(files, checkpoint, trigger, handle, ledger)


RETRY = "retry"
