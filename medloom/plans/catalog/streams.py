"""Streaming runs to the end of the available input, shown by what they wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom import streaming
from medloom.functions.documents import path
from medloom.plans import fixtures
from medloom.plans.catalog.base import Query, sql
from medloom.plans.catalog.ingest import file_no
from medloom.plans.landing import ndjson_files
from medloom.session import scratch_dir
from medloom.sources.readers import read_ndjson_lines


def _event_stream(m) -> DataFrame:
    """The events file as a stream, with the columns of ``fixtures.events``."""
    schema = fixtures.table(m.spark, m.sf_dir, "events").schema
    stream = (
        m.spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(m.sf_dir)
    )
    return fixtures.with_ingestion(stream)


def stream_validate_landing(m):
    out = scratch_dir(m.spark, "validated")
    landing = ndjson_files(m.spark, m.sf_dir)
    streaming.stream_validate_landing(
        m.spark, landing, out, scratch_dir(m.spark, "checkpoint"), glob="part-*"
    ).awaitTermination()
    failed = m.spark.read.schema("source_file string, error string").json(f"{out}/quarantine")
    passed = read_ndjson_lines(m.spark, f"{out}/processed", numbered=False)
    doc = F.try_parse_json("value")
    # Every part of a file bears the name of the part that was uploaded; the folder above it is gone.
    kept = passed.select(path(".id", doc=doc).alias("id"), path(".meta", "variant", doc).isNotNull().alias("has_meta"))
    return failed.select(file_no(), "error").unionByName(kept, allowMissingColumns=True)


def stream_raw_ingest(m):
    """Files arrive in several micro-batches; a second query finds all of them in the ledger but for
    those that the first one was not shown. Every line is in the table once."""
    table, ledger = scratch_dir(m.spark, "raw"), scratch_dir(m.spark, "ledger")
    # File names are part-<number>...: the first query sees those of even numbers.
    for numbers in ("[02468]", "?"):
        streaming.stream_raw_ingest(
            m.spark,
            ndjson_files(m.spark, m.sf_dir),
            table,
            "patients",
            scratch_dir(m.spark, "checkpoint"),
            glob=f"part-????{numbers}*",
            max_files=2,
            ledger=ledger,
        ).awaitTermination()
    return streaming.read_loaded(m.spark, table, ledger).select(
        file_no(), F.col("source_file_row_number").alias("row_no"), path(".id").alias("id")
    )


def stream_bundle_ingest(m):
    """Requests with an error come back twice; after the third receive they are dead letters."""
    requests, out = scratch_dir(m.spark, "requests"), scratch_dir(m.spark, "bundles")
    fixtures.bundle_requests(m.spark, m.sf_dir).write.json(requests)
    checkpoint = scratch_dir(m.spark, "checkpoint")
    for _ in range(3):
        streaming.stream_bundle_ingest(m.spark, requests, out, checkpoint).awaitTermination()
    raw = m.spark.read.parquet(f"{out}/raw").select(
        "request_id",
        "organization_id",
        "requested_at",
        F.col("entry_position").cast("bigint").alias("entry_position"),
        "resource_type",
        path(".id").alias("id"),
        F.lit(None).cast("string").alias("error"),
        F.lit(None).cast("bigint").alias("receives"),
    )
    dead = m.spark.read.schema(
        "request_id string, organization_id string, requested_at timestamp_ntz, error string, receives bigint"
    ).json(f"{out}/dead_letter").drop("run", "batch_id")
    return raw.unionByName(dead, allowMissingColumns=True)


def stream_ingest_rate(m):
    out = scratch_dir(m.spark, "rate")
    stream = _event_stream(m).withColumn("ts", F.col("ts").cast("timestamp"))
    streaming.stream_ingest_rate(
        stream, "ts", out, scratch_dir(m.spark, "checkpoint")
    ).awaitTermination()
    written = streaming.latest_rates(m.spark.read.parquet(out))
    return written.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def ingest_rate(m):
    events = fixtures.events(m.spark, m.sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    rate = streaming.ingest_rate(events, "ts")
    return rate.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def stream_job_status(m):
    out = scratch_dir(m.spark, "status")
    streaming.stream_job_status(
        _event_stream(m).select("job_id", "status", "ts"), out, scratch_dir(m.spark, "checkpoint")
    ).awaitTermination()
    return streaming.job_latest_status(m.spark.read.parquet(out))


_RATE = """SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, count(*) AS records,
                  round(count(*) / 300, 6) AS records_per_second
           FROM ev GROUP BY 1"""
_STATUS = """SELECT job_id, arg_max(status, (ts, list_position(
                 ['accepted', 'processing', 'completed', 'failed'], status))) AS status,
                 max(ts) AS ts
             FROM ev GROUP BY 1"""

_BUNDLE_ERROR = """CASE o_orderkey % 20
    WHEN 1 THEN 'Request body is empty' WHEN 2 THEN 'Invalid JSON'
    WHEN 3 THEN 'Expected resourceType ''Bundle'', got ''Patient'''
    WHEN 4 THEN 'Unsupported bundle type: searchset. Valid types: '
         || '[''transaction'', ''batch'', ''collection'', ''message'', ''document'']'
    WHEN 5 THEN 'Bundle contains no entries'
    WHEN 6 THEN 'Entry ' || entries || ' missing ''resource'' field' END"""

QUERIES: dict[str, Query] = {
    "stream_validate_landing": Query(
        stream_validate_landing,
        sql(
            """SELECT * FROM (
                   SELECT file_no, arg_min(error, row_no) FILTER (WHERE error IS NOT NULL) AS error,
                          NULL::VARCHAR AS id, NULL::BOOLEAN AS has_meta FROM checked GROUP BY 1)
               WHERE error IS NOT NULL
               UNION ALL
               SELECT NULL, NULL, c_custkey::VARCHAR, true FROM checked
               WHERE file_no NOT IN (SELECT file_no FROM checked WHERE error IS NOT NULL)""",
            "checked",
        ),
    ),
    "stream_raw_ingest": Query(
        stream_raw_ingest,
        sql(
            """SELECT file_no, row_no,
                      CASE WHEN kind IN ('ok', 'untyped') THEN c_custkey::VARCHAR END AS id
               FROM checked""",
            "checked",
        ),
    ),
    "stream_bundle_ingest": Query(
        stream_bundle_ingest,
        sql(
            f"""SELECT request_id, organization_id, requested_at, entry_position, resource_type,
                       id, NULL::VARCHAR AS error, NULL::BIGINT AS receives FROM req_entry
                UNION ALL SELECT request_id, organization_id, requested_at, NULL, NULL, NULL,
                       {_BUNDLE_ERROR}, 3 FROM req WHERE o_orderkey % 20 BETWEEN 1 AND 6""",
            "req_entry",
        ),
    ),
    "stream_ingest_rate": Query(
        stream_ingest_rate,
        sql(
            _RATE,
            "ev",
        ),
    ),
    "ingest_rate": Query(ingest_rate, sql(_RATE, "ev")),
    "ingest_lag": Query(
        lambda m: streaming.ingest_lag(
            fixtures.events(m.spark, m.sf_dir), "ts", "ingested_at", "event_type"
        ),
        sql(
            """SELECT event_type, count(*) AS records, round(avg(lag), 4) AS avg_lag_seconds,
                      max(lag) AS max_lag_seconds,
                      round(quantile_cont(lag, 0.95), 4) AS p95_lag_seconds
               FROM (SELECT *, event_id % 600 AS lag FROM ev) GROUP BY 1""",
            "ev",
        ),
    ),
    "stream_job_status": Query(stream_job_status, sql(_STATUS, "ev")),
    "job_latest_status": Query(
        lambda m: streaming.job_latest_status(fixtures.events(m.spark, m.sf_dir)),
        sql(_STATUS, "ev"),
    ),
}
