"""Ingestion jobs and uploads as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.functions.identity import job_date_path, job_id, safe_filename
from medloom.operators.bundles import entry_type_counts, validate_bundle
from medloom.schemas import UPLOAD_EXTENSIONS


def assign_job_id(df: DataFrame, request: str = "request_id", at: str = "requested_at") -> DataFrame:
    return df.withColumn("job_id", job_id(F.col(request), F.col(at)))


def landing_key(prefix: str, job: Column, now: Column) -> Column:
    """Object key of a bundle: ``<prefix>/webhooks/yyyy/MM/dd/<job>.json``."""
    return F.concat(
        F.lit(f"{prefix}/webhooks/"), job_date_path(job, now), F.lit("/"), job, F.lit(".json")
    )


def accepted_jobs(requests: DataFrame) -> DataFrame:
    """Valid bundles -> job rows: id, status, counts per type, entry count, created at."""
    valid = validate_bundle(requests).filter(F.col("error").isNull())
    return assign_job_id(valid).select(
        "request_id",
        "job_id",
        F.lit("accepted").alias("status"),
        entry_type_counts("bundle").alias("resource_counts"),
        F.size(F.try_variant_get("bundle", "$.entry", "array<variant>"))
        .cast("bigint")
        .alias("entry_count"),
        F.col("requested_at").alias("created_at"),
    )


def job_status(jobs: DataFrame, manifest: DataFrame, prefix: str, now: Column) -> DataFrame:
    """``processing`` for jobs whose bundle has landed, else ``not found``.

    ``jobs``: ``job_id`` (and optional others); ``manifest``: ``path, length,
    modificationTime`` with paths relative to the landing root.
    """
    landed = manifest.select(
        F.col("path").alias("landing_key"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    )
    keyed = jobs.withColumn("landing_key", landing_key(prefix, F.col("job_id"), now))
    found = F.col("last_modified").isNotNull()
    return keyed.join(landed, "landing_key", "left").withColumn(
        "status", F.when(found, "processing").otherwise("not found")
    )


def upload_manifest(requests: DataFrame, prefix: str, lifetime: int = 3600) -> DataFrame:
    """Upload requests -> object keys, or the first broken rule in ``error``.

    An empty content type means the default. A requested lifetime is only checked: every
    upload gets the service's own lifetime.
    """
    given = F.coalesce(F.col("content_type"), F.lit(""))
    content = F.when(given == "", "application/fhir+json").otherwise(given)
    allowed = ", ".join(UPLOAD_EXTENSIONS)
    error = F.when(
        ~content.isin(*UPLOAD_EXTENSIONS),
        F.concat(F.lit("Invalid contentType '"), given, F.lit(f"'. Allowed types: {allowed}")),
    ).when(
        ~F.col("expires_in").between(60, 86400),
        "expiresIn must be an integer between 60 and 86400 seconds",
    )
    extension = F.create_map(*[F.lit(x) for pair in UPLOAD_EXTENSIONS.items() for x in pair])
    folder = F.concat(
        F.lit(f"{prefix}/uploads/"), F.date_format("requested_at", "yyyy/MM/dd"), F.lit("/")
    )
    named = F.coalesce(F.length("filename"), F.lit(0)) > 0
    suffix = F.when(named, F.concat(F.lit("-"), safe_filename(F.col("filename")))).otherwise(
        F.element_at(extension, content)
    )
    expiry = F.lit(lifetime)
    ok = error.isNull()
    return requests.select(
        "upload_id",
        error.alias("error"),
        F.when(ok, content).alias("content_type"),
        F.when(ok, F.concat(folder, F.col("upload_id"), suffix)).alias("object_key"),
        F.when(ok, expiry).alias("expires_in"),
        F.when(ok, F.timestamp_add("SECOND", expiry, F.col("requested_at"))).alias("expires_at"),
    )


def route_uploads(uploads: DataFrame) -> DataFrame:
    """Uploaded objects -> tenant and job id, or an error.

    Input: ``object_key, meta_organization_id, meta_upload_id, size``. The tenant comes from
    the metadata, else from the third part of the key; the job id is the upload id, else
    the base name without extension.
    """
    parts = F.split("object_key", "/")
    from_key = F.try_element_at(parts, F.lit(3))
    tenant = F.coalesce(*[F.nullif(c, F.lit("")) for c in (F.col("meta_organization_id"), from_key)])
    base = F.replace(
        F.replace(F.element_at(parts, -1), F.lit(".json"), F.lit("")), F.lit(".ndjson"), F.lit("")
    )
    return uploads.select(
        "object_key",
        tenant.alias("organization_id"),
        F.coalesce(F.nullif(F.col("meta_upload_id"), F.lit("")), base).alias("job_id"),
        F.col("size").alias("file_size"),
        F.when(tenant.isNull(), "Missing organization_id").alias("error"),
    )


def route_tally(routed: DataFrame) -> DataFrame:
    return routed.agg(
        F.count_if(F.col("error").isNull()).alias("processed"),
        F.count_if(F.col("error").isNotNull()).alias("errors"),
    )
