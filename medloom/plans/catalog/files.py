"""Readers and writers: every query writes, reads back and shows what it read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.functions.documents import path
from medloom.operators import validation
from medloom.plans import fixtures
from medloom.plans.catalog.base import Query, sql
from medloom.plans.catalog.ingest import file_no
from medloom.plans.landing import ndjson_files
from medloom.session import scratch_dir
from medloom.sources import readers, writers


def _count(df: DataFrame, *by, name: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def read_ndjson_raw(m):
    raw = readers.read_ndjson_raw(m.spark, ndjson_files(m.spark, m.sf_dir), "patients")
    return raw.select(
        file_no(),
        F.col("source_file_row_number").alias("row_no"),
        path(".id").alias("id"),
        F.col("record_content").isNotNull().alias("parsed"),
    )


def _resources(m) -> DataFrame:
    return fixtures.patient_documents(m.spark, m.sf_dir)


def write_bundle(m):
    """Bundles of at most 200 entries: every entry with its bundle's type."""
    target = scratch_dir(m.spark, "bundles")
    writers.write_bundle(_resources(m), target, size=200)
    # A generator's output is computed once: each bundle is parsed once. What is said of a whole bundle
    # is found before its entries become rows, else it would be found, and carried, for each of them.
    parsed = F.explode(F.array(F.try_parse_json("value")))
    bundles = m.spark.read.text(target).select(parsed.alias("bundle")).select(
        path(".type", doc="bundle").alias("type"),
        (F.size(path(".entry", "array<variant>", "bundle")) <= 200).alias("bounded"),
        "bundle",
    )
    entries = bundles.select("type", "bounded", readers.explode_entries("bundle").alias("entry"))
    return entries.select("type", "bounded", path(".resource.id", doc="entry").alias("id"))


def read_bundle(m):
    target = scratch_dir(m.spark, "bundles")
    writers.write_bundle(_resources(m), target, size=200)
    return readers.read_bundle(m.spark, target).select(
        path(".id").alias("id"), path(".gender").alias("gender")
    )


def read_resource_files(m):
    """One Practitioner per supplier, one file each."""
    target = scratch_dir(m.spark, "resources")
    # A file costs milliseconds, so every core writes its share.
    supplier = fixtures.spread(fixtures.table(m.spark, m.sf_dir, "supplier"))
    body = F.struct(
        F.lit("Practitioner").alias("resourceType"),
        F.col("s_suppkey").cast("string").alias("id"),
        F.array(F.struct(F.col("s_name").alias("family"))).alias("name"),
    )
    supplier.select(F.to_json(body).alias("value")).write.option("maxRecordsPerFile", 1).text(
        target
    )
    return readers.read_resource_files(m.spark, target, "part-*").select(
        path(".id").alias("id"), path(".name[0].family").alias("family")
    )


def _csv(df: DataFrame, target: str) -> str:
    df.write.options(header="true", escape='"', emptyValue="").csv(target)
    return target


def _exported(m) -> dict[str, DataFrame]:
    """The OMOP tables as another system exports them: quotes, commas and line ends inside cells,
    markers for missing values, whole numbers with a decimal point."""
    key = F.col("person_id")
    quoted = F.concat(F.lit('say "'), "person_source_value", F.lit('",\nthen, "" go on'))
    number = F.col("visit_occurrence_id").cast("string")
    return {
        "person": m.person.drop("ingestion_timestamp").withColumns(
            {
                "person_source_value": F.when(key % 5 == 0, quoted).otherwise(F.col("person_source_value")),
                "gender_source_value": F.when(key % 7 == 0, "a,b").otherwise(F.col("gender_source_value")),
                "race_source_value": F.when(key % 3 == 0, "NA").otherwise(F.col("race_source_value")),
            }
        ),
        "condition_occurrence": m.condition.withColumn(
            "visit_occurrence_id", F.when(key % 11 == 0, F.concat(number, F.lit(".0"))).otherwise(number)
        ),
        "measurement": m.measurement.withColumn(
            "value_as_number",
            F.when(key % 13 == 0, "NaN").otherwise(F.col("value_as_number").cast("string")),
        ),
    }


def read_omop_csv(m):
    """A year that is no number keeps its whole column as text."""
    year = F.col("year_of_birth").cast("string")
    dirty = _exported(m)["person"].withColumn(
        "year_of_birth", F.when(F.col("person_id") % 89 == 0, "unknown").otherwise(year)
    )
    df, failed = readers.read_omop_csv(m.spark, _csv(dirty, scratch_dir(m.spark, "csv")), "person")
    return df.withColumn("unfit", F.lit(sum(failed.values())).cast("bigint"))


def convert_omop_dir(m):
    """All converted columns of all three tables, beside what the report says of the table."""
    source, target = scratch_dir(m.spark, "csv"), scratch_dir(m.spark, "omop")
    tables = _exported(m)
    for table, df in tables.items():
        _csv(df, f"{source}/{table}.csv")
    report = readers.convert_omop_dir(m.spark, source, target).select(
        "table", "rows", F.size("unfit_columns").cast("bigint").alias("unfit"), "error"
    )
    values = None
    for table in tables:
        own = m.spark.read.parquet(f"{target}/{table}.parquet").withColumn("table", F.lit(table))
        values = own if values is None else values.unionByName(own, allowMissingColumns=True)
    return values.join(report, "table")


# What the export above says, read right.
_PERSON_READ = """SELECT * EXCLUDE (_ingestion_ts) REPLACE (
        CASE WHEN person_id % 5 = 0
             THEN 'say "' || person_source_value || '",' || chr(10) || 'then, "" go on'
             ELSE person_source_value END AS person_source_value,
        CASE WHEN person_id % 7 = 0 THEN 'a,b' ELSE gender_source_value END AS gender_source_value,
        CASE WHEN person_id % 3 <> 0 THEN race_source_value END AS race_source_value)
    FROM person"""
_MEASUREMENT_READ = """SELECT * REPLACE (
        CASE WHEN person_id % 13 <> 0 THEN value_as_number END AS value_as_number) FROM meas"""


def write_ndjson(m):
    checked = validation.validate_ndjson(
        readers.read_ndjson_lines(m.spark, ndjson_files(m.spark, m.sf_dir))
    )
    valid, _ = validation.split_valid_quarantine(checked)
    target = scratch_dir(m.spark, "processed")
    # The original name is the folder the parts lie in.
    named = valid.withColumn("name", F.regexp_extract("source_file", r"file=([^/]+)/", 1))
    writers.write_ndjson(named, target, file="name")
    lines = readers.read_ndjson_lines(m.spark, target, numbered=False)
    doc = F.try_parse_json("value")
    return lines.select(
        file_no(), path(".id", doc=doc).alias("id"), path(".birthDate", doc=doc).alias("birth_date")
    )


def write_by_type_and_date(m):
    """Every document of the wanted types with its folder, and the count of its type."""
    raw = m.raw("patients").select("record_content")
    raw = raw.unionByName(m.raw("encounters").select("record_content"))
    raw = raw.unionByName(m.raw("observations").select("record_content"))
    moments = (".period.start", ".effectiveDateTime", ".effectivePeriod.start")
    known = [F.to_date(path(moment, "timestamp_ntz")) for moment in moments]
    # Observations lie under the first day of their month, which keeps the folders few. Patients have
    # no moment of their own; they lie under the day they came in.
    known[1:] = [F.trunc(moment, "month") for moment in known[1:]]
    day = F.coalesce(*known, F.lit("2025-01-01").cast("date"))
    target = scratch_dir(m.spark, "typed")
    types = ["Patient", "Encounter", "Observation", "Immunization"]
    counts = writers.write_by_type_and_date(raw, types, target, day)
    back = m.spark.read.text(target).select(
        "resource_type",
        F.col("date").cast("date").alias("date"),
        path(".id", doc=F.try_parse_json("value")).alias("id"),
    )
    return back.join(counts, "resource_type")


def write_date_partitioned(m):
    """Every request under its day, with the bundle inside."""
    target = scratch_dir(m.spark, "webhooks")
    requests = fixtures.bundle_requests(m.spark, m.sf_dir)
    writers.write_date_partitioned(requests, "requested_at", target)
    schema = "request_id string, organization_id string, body string, year int, month int, day int"
    bundle = F.try_parse_json("body")
    return m.spark.read.schema(schema).json(target).select(
        "request_id",
        "organization_id",
        "year",
        "month",
        "day",
        F.col("body").isNotNull().alias("has_body"),
        F.size(path(".entry", "array<variant>", bundle)).cast("bigint").alias("entries"),
    ).withColumn("entries", F.when(F.substring_index("request_id", "-", -1).cast("bigint") % 20 > 6, F.col("entries")))


def write_omop_partitioned(m):
    """Every row of the three tables with the folder it lies in."""
    out = None
    for table, df, key, column in (
        ("person", m.person, "person_id", "year_of_birth"),
        ("condition_occurrence", m.condition, "condition_occurrence_id", "condition_start_date"),
        ("measurement", m.measurement, "measurement_id", "measurement_date"),
    ):
        target = scratch_dir(m.spark, table)
        writers.write_omop_partitioned(df, table, target)
        own = m.spark.read.parquet(target).select(
            F.lit(table).alias("table"),
            F.col(column).cast("string").alias("folder"),
            F.col(key).cast("string").alias("id"),
        )
        out = own if out is None else out.unionByName(own)
    return out


def write_flat_parquet(m):
    target = scratch_dir(m.spark, "flat")
    writers.write_flat_parquet(m.flat_patient, target)
    return m.spark.read.parquet(target)


def write_run_scoped(m):
    """Whole rows of two runs; the zone beside them is not read."""
    root = scratch_dir(m.spark, "zones")
    person = m.person.drop("ingestion_timestamp")
    writers.write_run_scoped(m.flat_patient, root, "run-1", "fhir")
    writers.write_run_scoped(person, root, "run-1", "omop")
    writers.write_run_scoped(person, root, "run-2", "omop")
    return m.spark.read.option("basePath", f"{root}/runs").parquet(f"{root}/runs/*/omop")


def materialize_view(m):
    writers.materialize_view(m.stg_patient, "stg_patient")
    return m.spark.sql("SELECT gender, count(*) AS patients FROM stg_patient GROUP BY gender")


def materialize_table(m):
    target = scratch_dir(m.spark, "api_encounter")
    name = "api_encounter_" + target.rsplit("-", 1)[-1]
    table = writers.materialize_table(m.api_encounter, name, target)
    return _count(table.filter("is_active"), "class_code", name="active")


def source_manifest(m):
    files = readers.source_manifest(m.spark, ndjson_files(m.spark, m.sf_dir), "part-*")
    return files.groupBy(file_no("path")).agg(
        F.count(F.lit(1)).alias("files"), (F.sum("length") > 0).alias("has_bytes")
    )


QUERIES: dict[str, Query] = {
    "read_ndjson_raw": Query(
        read_ndjson_raw,
        sql(
            """SELECT file_no, row_no,
                      CASE WHEN kind IN ('ok', 'untyped') THEN c_custkey::VARCHAR END AS id,
                      kind <> 'bad' AS parsed
               FROM checked""",
            "checked",
        ),
    ),
    "read_bundle": Query(
        read_bundle, sql("SELECT patient_id AS id, gender FROM pat", "pat")
    ),
    "read_resource_files": Query(
        read_resource_files, "SELECT s_suppkey::VARCHAR AS id, s_name AS family FROM supplier"
    ),
    "read_omop_csv": Query(
        read_omop_csv,
        sql(
            f"""SELECT * REPLACE (CASE WHEN person_id % 89 = 0 THEN 'unknown'
                                  ELSE year_of_birth::VARCHAR END AS year_of_birth),
                       (SELECT count(*) FROM person WHERE person_id % 89 = 0) AS unfit
                FROM ({_PERSON_READ})""",
            "person",
        ),
    ),
    "convert_omop_dir": Query(
        convert_omop_dir,
        sql(
            f"""SELECT *, count(*) OVER (PARTITION BY "table") AS "rows", 0::BIGINT AS unfit,
                       NULL::VARCHAR AS error
                FROM (SELECT 'person' AS "table", * FROM ({_PERSON_READ})
                      UNION ALL BY NAME SELECT 'condition_occurrence' AS "table", * FROM cond
                      UNION ALL BY NAME SELECT 'measurement' AS "table", * FROM ({_MEASUREMENT_READ}))""",
            "person",
            "cond",
            "meas",
        ),
    ),
    "read_parquet_table": Query(
        lambda m: readers.read_parquet_table(
            m.spark, m.sf_dir, "lineitem", ["l_orderkey", "l_quantity"]
        ),
        "SELECT l_orderkey, l_quantity FROM lineitem",
    ),
    "write_flat_parquet": Query(write_flat_parquet, sql("SELECT * FROM flat", "flat")),
    "write_ndjson": Query(
        write_ndjson,
        sql(
            """SELECT file_no, c_custkey::VARCHAR AS id,
                      (DATE '1920-01-01' + ((c_custkey * 37) % 36500)::INTEGER)::VARCHAR
                          AS birth_date
               FROM checked WHERE kind = 'ok'""",
            "checked",
        ),
    ),
    "write_bundle": Query(
        write_bundle,
        "SELECT c_custkey::VARCHAR AS id, true AS bounded, 'collection' AS type FROM customer",
    ),
    "write_by_type_and_date": Query(
        write_by_type_and_date,
        sql(
            """SELECT *, count(*) OVER (PARTITION BY resource_type) AS record_count
               FROM (SELECT 'Patient' AS resource_type, DATE '2025-01-01' AS date, patient_id AS id
                     FROM pat
                     UNION ALL SELECT 'Encounter', period_start::DATE, encounter_id FROM enc
                     UNION ALL SELECT 'Observation',
                            date_trunc('month',
                                coalesce(effective_datetime, effective_period_start))::DATE,
                            observation_id FROM obs)""",
            "pat",
            "enc",
            "obs",
        ),
    ),
    "write_date_partitioned": Query(
        write_date_partitioned,
        sql(
            """SELECT request_id, organization_id, year(requested_at)::INTEGER AS year,
                      month(requested_at)::INTEGER AS month, day(requested_at)::INTEGER AS day,
                      true AS has_body,
                      CASE WHEN o_orderkey % 20 > 6 THEN entries::BIGINT END AS entries
               FROM req""",
            "req",
        ),
    ),
    "write_omop_partitioned": Query(
        write_omop_partitioned,
        sql(
            """SELECT 'person' AS "table", year_of_birth::VARCHAR AS folder,
                      person_id::VARCHAR AS id FROM person
               UNION ALL SELECT 'condition_occurrence', condition_start_date,
                      condition_occurrence_id FROM cond
               UNION ALL SELECT 'measurement', measurement_date, measurement_id FROM meas""",
            "person",
            "cond",
            "meas",
        ),
    ),
    "write_run_scoped": Query(
        write_run_scoped,
        sql(
            """SELECT * EXCLUDE (_ingestion_ts)
               FROM person, (VALUES ('run-1'), ('run-2')) AS runs(pipeline_run_id)""",
            "person",
        ),
    ),
    "materialize_view": Query(
        materialize_view,
        sql("SELECT gender, count(*) AS patients FROM pat GROUP BY gender", "pat"),
    ),
    "materialize_table": Query(
        materialize_table,
        sql(
            """SELECT class_code, count(*) AS active FROM enc WHERE status = 'in-progress'
               GROUP BY 1""",
            "enc",
        ),
    ),
    "source_manifest": Query(
        source_manifest,
        sql(
            """SELECT file_no, 1::BIGINT AS files, true AS has_bytes FROM line GROUP BY 1""",
            "line",
        ),
    ),
}
