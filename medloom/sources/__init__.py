from medloom.sources.csv import csv_records
from medloom.sources.history import History
from medloom.sources.lookup import LookupTable
from medloom.sources.readers import (
    convert_omop_dir,
    read_bundle,
    read_ndjson_lines,
    read_ndjson_raw,
    read_omop_csv,
    read_parquet_table,
    read_resource_files,
    source_manifest,
)
from medloom.sources.substrings import SubstringIndex
from medloom.sources.writers import (
    materialize_table,
    materialize_view,
    write_bucketed,
    write_bundle,
    write_by_type_and_date,
    write_date_partitioned,
    write_flat_parquet,
    write_ndjson,
    write_omop_partitioned,
    write_raw_table,
    write_run_scoped,
)

__all__ = [
    "History",
    "LookupTable",
    "SubstringIndex",
    "convert_omop_dir",
    "csv_records",
    "materialize_table",
    "materialize_view",
    "read_bundle",
    "read_ndjson_lines",
    "read_ndjson_raw",
    "read_omop_csv",
    "read_parquet_table",
    "read_resource_files",
    "source_manifest",
    "write_bucketed",
    "write_bundle",
    "write_by_type_and_date",
    "write_date_partitioned",
    "write_flat_parquet",
    "write_ndjson",
    "write_omop_partitioned",
    "write_raw_table",
    "write_run_scoped",
]
