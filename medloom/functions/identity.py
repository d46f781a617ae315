"""Ids, tokens and object names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokenize(value: Column, organization: Column, salt: str) -> Column:
    """Hex token, equal for equal values inside one organization only."""
    return F.sha2(F.concat(organization, F.lit(f":{salt}:"), value), 256)


def job_id(request: Column, at: Column) -> Column:
    """``job-<yyyyMMddHHmmss>-<8 hex digits>``."""
    stamp = F.date_format(at, "yyyyMMddHHmmss")
    return F.concat(F.lit("job-"), stamp, F.lit("-"), F.md5(F.concat(request, stamp)).substr(1, 8))


def job_date_path(job: Column, today: Column) -> Column:
    """``yyyy/MM/dd`` from the second part of a job id, else today's path."""
    stamp = F.split_part(job, F.lit("-"), F.lit(2))
    found = F.concat_ws("/", stamp.substr(1, 4), stamp.substr(5, 2), stamp.substr(7, 2))
    return F.when(job.contains("-"), found).otherwise(F.date_format(today, "yyyy/MM/dd"))


def safe_filename(name: Column) -> Column:
    """Only letters, digits, ``-_.``; 100 characters; no outer underscores; never empty."""
    cut = F.regexp_replace(name, r"[^A-Za-z0-9_.\-]", "_").substr(1, 100)
    return F.coalesce(F.nullif(F.trim(cut, F.lit("_")), F.lit("")), F.lit("upload"))
