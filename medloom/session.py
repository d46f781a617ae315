"""Session settings and scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime SQL settings the operators rely on; all can be set on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # FHIR senders may repeat a key; keep the last one instead of losing the document.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Raw documents are stored shredded, and paths are read as leaf columns.
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Compressed files unpack to a multiple of their size: count that in broadcasts planned
    # from file sizes. At run time adaptive execution uses measured sizes.
    "spark.sql.sources.fileCompressionFactor": "2.0",
    # Split a hot patient / encounter key at run time, also where that costs a shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A page far down the list falls back to a distributed sort instead of a heap.
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``RUNTIME_CONF`` to a session that somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "medloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused path under the shared folder named in ``spark.checkpoint.dir``.

    Only a session without that setting (a test) gets a machine-local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="medloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, f"medloom-{purpose}-{uuid.uuid4().hex}")


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the scratch folder: computed once, however many read it."""
    target = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def sized(df: DataFrame, purpose: str, max_rows: int) -> DataFrame:
    """Write a frame that should be small to the scratch folder and read it back.

    Runs a job. The rows are counted from the written files: up to ``max_rows`` the frame is
    marked for broadcast, beyond that it joins by shuffle like any other.
    """
    spark = df.sparkSession
    target = scratch_dir(spark, purpose)
    df.write.parquet(target)
    written = spark.read.parquet(target)
    return F.broadcast(written) if written.count() <= max_rows else written
