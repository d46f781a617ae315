"""Validation of landed documents, bundles, jobs and uploads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.functions.documents import path
from medloom.functions.identity import job_date_path
from medloom.operators import bundles, jobs, validation
from medloom.plans import fixtures
from medloom.plans.catalog.base import Query, sql
from medloom.plans.landing import ndjson_files
from medloom.session import kept
from medloom.sources.readers import read_ndjson_lines

_NOW = "2025-01-01 00:00:00"


def _checked_once(m) -> DataFrame:
    return kept(_checked(m), "checked")


def _checked(m) -> DataFrame:
    lines = read_ndjson_lines(m.spark, ndjson_files(m.spark, m.sf_dir))
    return validation.validate_ndjson(lines)


def file_no(column: str = "source_file"):
    return F.regexp_extract(column, r"patients_(\d+)\.ndjson", 1).cast("bigint").alias("file_no")


def validate_ndjson(m):
    return _checked(m).select(
        file_no(),
        F.col("source_file_row_number").alias("row_no"),
        path(".id").alias("id"),
        "error",
    )


def add_default_meta(m):
    valid, _ = validation.split_valid_quarantine(_checked(m))
    doc = F.try_parse_json("value")
    return valid.select(
        path(".id").alias("id"),
        path(".meta.source", doc=doc).alias("source"),
        path(".meta", "variant", doc=doc).isNotNull().alias("has_meta"),
        path(".gender", doc=doc).alias("gender"),
    )


def split_valid_quarantine(m):
    valid, bad = validation.split_valid_quarantine(_checked_once(m))

    def counted(df: DataFrame, zone: str) -> DataFrame:
        counts = df.groupBy(file_no()).agg(F.count(F.lit(1)).alias("lines"))
        return counts.withColumn("zone", F.lit(zone))

    return counted(valid, "processed").unionByName(counted(bad, "quarantine"))


def split_files(m):
    """Lines that get through by file, and the first error of the files that do not."""
    valid, failed = validation.split_valid_quarantine_files(_checked_once(m))
    passed = valid.groupBy(file_no()).agg(F.count(F.lit(1)).alias("passed_lines"))
    return failed.select(file_no(), "error").unionByName(passed, allowMissingColumns=True)


def _requests(m) -> DataFrame:
    return fixtures.bundle_requests(m.spark, m.sf_dir)


def _valid_bundles(m) -> DataFrame:
    return bundles.validate_bundle(_requests(m)).filter(F.col("error").isNull())


def explode_bundle(m):
    rows = bundles.explode_bundle(_valid_bundles(m).select("request_id", "bundle"))
    return rows.select(
        "request_id", path(".resourceType").alias("resource_type"), path(".id").alias("id")
    )


def filter_resource_type(m):
    rows = bundles.explode_bundle(_valid_bundles(m).select("request_id", "bundle"))
    return validation.filter_resource_type(rows, "Encounter").select("request_id", "value")


def accepted_jobs(m):
    counts = F.col("resource_counts")
    return jobs.accepted_jobs(_requests(m)).select(
        "request_id",
        "job_id",
        "status",
        "entry_count",
        "created_at",
        counts["Observation"].alias("observations"),
        counts["Unknown"].alias("unknown"),
    )


def job_status(m):
    """Bundles of every tenth accepted job have not landed."""
    accepted = jobs.accepted_jobs(_requests(m)).select("request_id", "job_id", "created_at")
    key = F.substring("request_id", 5, 20).cast("bigint")
    now = F.lit(_NOW).cast("timestamp_ntz")
    landed = jobs.landing_key("incoming", F.col("job_id"), now)
    manifest = accepted.select(
        F.when(key % 10 == 0, F.concat(landed, F.lit(".part"))).otherwise(landed).alias("path"),
        key.alias("length"),
        F.col("created_at").alias("modificationTime"),
    )
    found = jobs.job_status(accepted.select("job_id"), manifest, "incoming", now)
    return found.select("job_id", "landing_key", "status", "size")


_STAMP = "strftime(requested_at, '%Y%m%d%H%M%S')"
_JOB = f"'job-' || {_STAMP} || '-' || substr(md5(request_id || {_STAMP}), 1, 8)"
_ERROR = """CASE o_orderkey % 20
    WHEN 1 THEN 'Request body is empty' WHEN 2 THEN 'Invalid JSON'
    WHEN 3 THEN 'Expected resourceType ''Bundle'', got ''Patient'''
    WHEN 4 THEN 'Unsupported bundle type: searchset. Valid types: '
         || '[''transaction'', ''batch'', ''collection'', ''message'', ''document'']'
    WHEN 5 THEN 'Bundle contains no entries'
    WHEN 6 THEN 'Entry ' || entries || ' missing ''resource'' field' END"""
_VALID = "o_orderkey % 20 NOT BETWEEN 1 AND 6"

_UPLOADS = """
    SELECT *, regexp_replace(filename, '[^A-Za-z0-9_.-]', '_', 'g') AS clean
    FROM (SELECT 'upload-' || o_orderkey AS upload_id, o_orderdate AS requested_at,
                 CASE o_orderkey % 5 WHEN 0 THEN NULL
                      WHEN 1 THEN 'lab report #' || o_orderkey || '.json'
                      WHEN 2 THEN repeat('a', 98) || '__' || o_orderkey
                      WHEN 3 THEN '__ä__' ELSE '../etc/' || o_orderkey || '_' END AS filename,
                 CASE o_orderkey % 6 WHEN 0 THEN 'application/fhir+json'
                      WHEN 1 THEN 'application/fhir+json' WHEN 2 THEN 'application/json'
                      WHEN 3 THEN 'application/fhir+ndjson' WHEN 4 THEN 'application/x-ndjson'
                      ELSE 'text/plain' END AS content_type,
                 CASE o_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 59 WHEN 2 THEN 86401
                      ELSE 60 + o_orderkey % 86000 END AS asked
          FROM orders)"""
_UPLOAD_ERROR = """CASE WHEN content_type = 'text/plain' THEN
    'Invalid contentType ''text/plain''. Allowed types: application/fhir+json, '
        || 'application/json, application/fhir+ndjson, application/x-ndjson'
    WHEN asked < 60 OR asked > 86400 THEN
    'expiresIn must be an integer between 60 and 86400 seconds' END"""

_ROUTED = """
    SELECT object_key, CASE WHEN o_orderkey % 4 = 0 THEN 'meta-' || tenant
                            WHEN o_orderkey % 9 <> 0 THEN tenant END AS organization_id,
           CASE WHEN o_orderkey % 3 = 0 THEN 'upload-' || o_orderkey
                ELSE 'u' || o_orderkey END AS job_id,
           o_orderkey AS file_size
    FROM (SELECT o_orderkey, 'org-' || (o_orderkey % 5) AS tenant,
                 CASE WHEN o_orderkey % 9 = 0 THEN 'incoming/' || o_orderkey || '.json'
                      ELSE 'incoming/fhir/org-' || (o_orderkey % 5) || '/2024/u' || o_orderkey
                           || CASE WHEN o_orderkey % 2 = 0 THEN '.json' ELSE '.ndjson' END
                 END AS object_key FROM orders)"""

QUERIES: dict[str, Query] = {
    "validate_ndjson": Query(
        validate_ndjson,
        sql(
            """SELECT file_no, row_no,
                      CASE WHEN kind IN ('ok', 'untyped') THEN c_custkey::VARCHAR END AS id, error
               FROM checked""",
            "checked",
        ),
    ),
    "add_default_meta": Query(
        add_default_meta,
        sql(
            """SELECT c_custkey::VARCHAR AS id,
                      CASE WHEN c_custkey % 13 <> 0 THEN 'synthetic' END AS source,
                      true AS has_meta,
                      CASE c_custkey % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'female'
                           WHEN 2 THEN 'other' ELSE 'unknown' END AS gender
               FROM checked WHERE kind = 'ok'""",
            "checked",
        ),
    ),
    "split_valid_quarantine": Query(
        split_valid_quarantine,
        sql(
            """SELECT file_no, count(*) AS lines,
                      CASE WHEN error IS NULL THEN 'processed' ELSE 'quarantine' END AS zone
               FROM checked GROUP BY 1, 3""",
            "checked",
        ),
    ),
    "split_valid_quarantine_files": Query(
        split_files,
        sql(
            """SELECT file_no, arg_min(error, row_no) FILTER (WHERE error IS NOT NULL) AS error,
                      CASE WHEN count(error) = 0 THEN count(*) END AS passed_lines
               FROM checked GROUP BY 1""",
            "checked",
        ),
    ),
    "validate_bundle": Query(
        lambda m: bundles.validate_bundle(_requests(m)).select("request_id", "error"),
        sql(f"SELECT request_id, {_ERROR} AS error FROM req", "req"),
    ),
    "explode_bundle": Query(
        explode_bundle,
        sql(
            """SELECT request_id, nullif(resource_type, 'Unknown') AS resource_type, id
               FROM req_entry""",
            "req_entry",
        ),
    ),
    "filter_resource_type": Query(
        filter_resource_type,
        sql(
            """SELECT request_id, '{"id":"' || id || '","resourceType":"Encounter"}' AS value
               FROM req_entry WHERE resource_type = 'Encounter'""",
            "req_entry",
        ),
    ),
    "count_resources": Query(
        lambda m: bundles.count_resources(_valid_bundles(m), ["request_id"]),
        sql(
            """SELECT request_id, resource_type, count(*) AS resource_count
               FROM req_entry GROUP BY 1, 2""",
            "req_entry",
        ),
    ),
    "assign_job_id": Query(
        lambda m: jobs.assign_job_id(_requests(m)).select("request_id", "job_id"),
        sql(f"SELECT request_id, {_JOB} AS job_id FROM req", "req"),
    ),
    "job_date_path": Query(
        lambda m: jobs.assign_job_id(_requests(m)).select(
            "request_id",
            job_date_path(
                F.when(
                    F.substring("request_id", 5, 20).cast("bigint") % 11 == 0, "nodash"
                ).otherwise(F.col("job_id")),
                F.lit(_NOW).cast("timestamp_ntz"),
            ).alias("date_path"),
        ),
        sql(
            """SELECT request_id, CASE WHEN o_orderkey % 11 = 0 THEN '2025/01/01'
                      ELSE strftime(requested_at, '%Y/%m/%d') END AS date_path FROM req""",
            "req",
        ),
    ),
    "job_status": Query(
        job_status,
        sql(
            f"""SELECT job_id, 'incoming/webhooks/' || day || '/' || job_id || '.json'
                           AS landing_key,
                       CASE WHEN o_orderkey % 10 = 0 THEN 'not found' ELSE 'processing' END
                           AS status,
                       CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey END AS size
                FROM (SELECT *, {_JOB} AS job_id, strftime(requested_at, '%Y/%m/%d') AS day
                      FROM req WHERE {_VALID})""",
            "req",
        ),
    ),
    "accepted_jobs": Query(
        accepted_jobs,
        sql(
            f"""SELECT request_id, {_JOB} AS job_id, 'accepted' AS status,
                       entries::BIGINT AS entry_count, requested_at AS created_at,
                       CASE WHEN o_orderkey % 3 = 0 THEN 2::BIGINT END AS observations,
                       CASE WHEN o_orderkey % 7 = 0 THEN 1::BIGINT END AS unknown
                FROM req WHERE {_VALID}""",
            "req",
        ),
    ),
    "upload_manifest": Query(
        lambda m: jobs.upload_manifest(fixtures.upload_requests(m.spark, m.sf_dir), "incoming"),
        f"""SELECT upload_id, error, CASE WHEN error IS NULL THEN content_type END
                       AS content_type,
                   CASE WHEN error IS NULL THEN 'incoming/uploads/'
                        || strftime(requested_at, '%Y/%m/%d') || '/' || upload_id
                        || CASE WHEN filename IS NULL THEN
                                CASE WHEN content_type LIKE '%ndjson' THEN '.ndjson'
                                     ELSE '.json' END
                           ELSE '-' || coalesce(nullif(trim(substr(clean, 1, 100), '_'), ''),
                                                'upload') END
                   END AS object_key,
                   CASE WHEN error IS NULL THEN 3600 END AS expires_in,
                   CASE WHEN error IS NULL THEN requested_at + INTERVAL 1 HOUR END AS expires_at
            FROM (SELECT *, {_UPLOAD_ERROR} AS error FROM ({_UPLOADS}))""",
    ),
    "route_uploads": Query(
        lambda m: jobs.route_uploads(fixtures.upload_events(m.spark, m.sf_dir)),
        f"""SELECT object_key, organization_id,
                   CASE WHEN object_key LIKE 'incoming/fhir/%' OR job_id LIKE 'upload-%'
                        THEN job_id ELSE substr(job_id, 2) END AS job_id, file_size,
                   CASE WHEN organization_id IS NULL THEN 'Missing organization_id' END AS error
            FROM ({_ROUTED})""",
    ),
    "route_tally": Query(
        lambda m: jobs.route_tally(
            jobs.route_uploads(fixtures.upload_events(m.spark, m.sf_dir))
        ),
        f"""SELECT count(organization_id) AS processed,
                   count(*) - count(organization_id) AS errors FROM ({_ROUTED})""",
    ),
}
