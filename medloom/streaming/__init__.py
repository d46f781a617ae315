from medloom.streaming.landing import (
    stream_bundle_ingest,
    stream_raw_ingest,
    stream_validate_landing,
)
from medloom.streaming.ledger import LoadLedger, read_loaded
from medloom.streaming.monitoring import (
    ingest_lag,
    ingest_rate,
    job_latest_status,
    late_rows,
    latest_rates,
    stream_ingest_rate,
    stream_job_status,
)

__all__ = [
    "LoadLedger",
    "ingest_lag",
    "ingest_rate",
    "job_latest_status",
    "late_rows",
    "latest_rates",
    "read_loaded",
    "stream_bundle_ingest",
    "stream_ingest_rate",
    "stream_job_status",
    "stream_raw_ingest",
    "stream_validate_landing",
]
