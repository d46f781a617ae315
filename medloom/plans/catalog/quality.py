"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from medloom.functions.clinical import age_years
from medloom.operators import drift, quality
from medloom.plans.catalog.base import Query, sql
from medloom.plans.fixtures import AS_OF, run_log
from medloom.schemas import API_ENCOUNTER_CONTRACT, API_PATIENT_CONTRACT
from medloom.session import scratch_dir
from medloom.sources.readers import source_manifest
from medloom.sources.writers import write_flat_parquet


def _check(check: str, subject: str, violations: str, total: str, source: str, *inputs: str) -> str:
    return sql(
        f"""SELECT '{check}' AS "check", '{subject}' AS subject, v AS violations, n AS total,
                   v = 0 AS passed
            FROM (SELECT ({violations})::BIGINT AS v, ({total})::BIGINT AS n {source})""",
        *inputs,
    )


_DOMAINS = {
    "patient": [
        {
            "id": "birth_years",
            "type": "range",
            "model": "omop.person",
            "field": "year_of_birth",
            "min": 1930,
            "max": 2000,
        },
        {
            "id": "no_such_field",
            "type": "range",
            "model": "omop.person",
            "field": "height",
            "min": 0,
            "max": 300,
        },
        {
            "id": "no_such_table",
            "type": "range",
            "model": "omop.visit",
            "field": "year",
            "min": 0,
            "max": 1,
        },
        {
            "id": "other_model",
            "type": "range",
            "model": "fhir.patient",
            "field": "year",
            "min": 0,
            "max": 1,
        },
    ],
    "measurement": [
        {
            "id": "values",
            "type": "range",
            "model": "omop.measurement",
            "field": "value_as_number",
            "min": 5,
            "max": 45,
        }
    ],
}


def _ages(m):
    age = age_years(F.col("birth_date"), F.lit(None).cast("date"), AS_OF)
    return m.stg_patient.select(age.alias("age"))


_MAX_GAP = 0.05


def dq_drift(m):
    """Ages of each gender against the profile, from sketches of gender and state that are merged."""
    age = age_years(F.col("birth_date"), F.lit(None).cast("date"), AS_OF)
    people = m.stg_patient.select("gender", "state", age.alias("age"))
    by_state = drift.distribution_sketches(people, "age", ["gender", "state"])
    merged = drift.merge_sketches(by_state, ["gender"])
    return drift.dq_drift(merged, F.concat(F.lit("age of "), "gender"), _MAX_GAP)


# The same points, with exact shares.
_POINTS = ", ".join(f"({value!r}, {share!r})" for value, share in drift.profile_points())


def dq_contract(m):
    return quality.dq_contract(m.api_patient, API_PATIENT_CONTRACT)


def dq_contract_broken(m):
    """The encounter mart against a contract that it does not keep."""
    contract = dict(API_ENCOUNTER_CONTRACT)
    contract["service_provider"] = ("string", ())
    contract["duration_hours"] = ("double", ())
    contract["reason_code"] = ("string", ("not_null",))
    contract["patient_id"] = ("string", ("not_null", "unique"))
    del contract["is_active"]
    found = quality.dq_contract(m.api_encounter, contract)
    return found.filter(~F.col("passed"))


def dq_report(m):
    results = [
        quality.dq_not_null(m.stg_encounter, "encounter_id", "period_end"),
        quality.dq_unique(m.stg_patient, "patient_id"),
        quality.dq_terminology(m.condition, "condition_concept_id"),
    ]
    return quality.dq_report(results, "run-7", scratch_dir(m.spark, "dq-report"))


def expected_outputs(m):
    target = scratch_dir(m.spark, "outputs")
    write_flat_parquet(m.person, f"{target}/person.parquet")
    write_flat_parquet(m.condition, f"{target}/condition_occurrence.parquet")
    found = quality.expected_outputs(
        source_manifest(m.spark, target, "*.parquet"),
        ["person.parquet", "condition_occurrence.parquet", "measurement.parquet"],
    )
    return found.select("output", "found", (F.col("bytes") > 0).alias("has_bytes"))


_CROSS = ["person_d", "flat_d"]
_MISSING_FHIR = """(SELECT count(*) FROM (SELECT person_id FROM person_d EXCEPT
                    SELECT person_id_omop FROM flat_d))"""
_MISSING_OMOP = """(SELECT count(*) FROM (SELECT person_id_omop FROM flat_d EXCEPT
                    SELECT person_id FROM person_d))"""
_WRONG_BIRTH = """count(*) FILTER (WHERE birth_date IS NOT NULL AND NOT (
    year_of_birth IS NOT DISTINCT FROM year(birth_date::DATE)
    AND month_of_birth IS NOT DISTINCT FROM month(birth_date::DATE)
    AND day_of_birth IS NOT DISTINCT FROM day(birth_date::DATE)))"""
_PAIRS = "FROM person_d JOIN flat_d ON person_id = person_id_omop"

_CROSS_ROWS = f"""
    SELECT 'cross_model_ids' AS "check", 'missing_in_fhir' AS subject, {_MISSING_FHIR} AS v,
           (SELECT count(DISTINCT person_id) FROM person_d) AS n
    UNION ALL SELECT 'cross_model_ids', 'missing_in_omop', {_MISSING_OMOP},
           (SELECT count(DISTINCT person_id_omop) FROM flat_d)"""


def _rows(rows: str, *inputs: str) -> str:
    return sql(
        f"""SELECT "check", subject, v::BIGINT AS violations, n::BIGINT AS total, v = 0 AS passed
            FROM ({rows})""",
        *inputs,
    )


QUERIES: dict[str, Query] = {
    "dq_unique": Query(
        lambda m: quality.dq_unique(m.stg_encounter, "patient_id"),
        _check(
            "unique", "patient_id", "count(*) FILTER (WHERE c > 1)", "sum(c)",
            "FROM (SELECT count(*) AS c FROM enc WHERE patient_id IS NOT NULL GROUP BY patient_id)",
            "enc",
        ),
    ),
    "dq_not_null": Query(
        lambda m: quality.dq_not_null(m.stg_encounter, "encounter_id", "period_end", "reason_code"),
        _rows(
            """SELECT 'not_null' AS "check", c AS subject,
                      CASE c WHEN 'encounter_id' THEN count(*) FILTER (WHERE encounter_id IS NULL)
                             WHEN 'period_end' THEN count(*) FILTER (WHERE period_end IS NULL)
                             ELSE count(*) FILTER (WHERE reason_code IS NULL) END AS v,
                      count(*) AS n
               FROM enc, (VALUES ('encounter_id'), ('period_end'), ('reason_code')) t(c)
               GROUP BY c""",
            "enc",
        ),
    ),
    "dq_accepted_values": Query(
        lambda m: quality.dq_accepted_values(m.stg_patient, "gender", ["male", "female"]),
        _check(
            "accepted_values", "gender",
            "count(*) FILTER (WHERE gender NOT IN ('male', 'female'))", "count(*)", "FROM pat",
            "pat",
        ),
    ),
    "dq_contract": Query(
        dq_contract,
        _rows(
            """SELECT unnest(['contract_column', 'contract_type']) AS "check", c AS subject,
                      0 AS v, 1 AS n
               FROM (VALUES ('patient_id'), ('active'), ('gender'), ('birth_date'),
                     ('deceased_datetime'), ('name_family'), ('name_given'), ('city'), ('state'),
                     ('postal_code'), ('country'), ('source_file'), ('ingestion_time'),
                     ('full_name'), ('age'), ('is_deceased')) t(c)
               UNION ALL SELECT unnest(['not_null', 'unique']), 'patient_id', 0, count(*)
               FROM pat""",
            "pat",
        ),
    ),
    "dq_contract_broken": Query(
        dq_contract_broken,
        _rows(
            """SELECT 'contract_column' AS "check", 'service_provider' AS subject, 1 AS v, 1 AS n
               UNION ALL SELECT 'contract_type', 'duration_hours', 1, 1
               UNION ALL SELECT 'contract_extra_column', 'is_active', 1, 1
               UNION ALL SELECT 'not_null', 'reason_code',
                      count(*) FILTER (WHERE reason_code IS NULL), count(*) FROM enc
               UNION ALL SELECT 'unique', 'patient_id', count(*) FILTER (WHERE c > 1), sum(c)
               FROM (SELECT count(*) AS c FROM enc GROUP BY patient_id)""",
            "enc",
        ),
    ),
    "dq_domain_range": Query(
        lambda m: quality.dq_domain_range(
            {"person": m.person, "measurement": m.measurement}, _DOMAINS
        ),
        _rows(
            """SELECT 'range' AS "check", 'birth_years' AS subject,
                      count(*) FILTER (WHERE year_of_birth < 1930 OR year_of_birth > 2000) AS v,
                      count(*) AS n FROM person
               UNION ALL SELECT 'range', 'values',
                      count(*) FILTER (WHERE value_as_number < 5 OR value_as_number > 45),
                      count(*) FROM meas
               UNION ALL SELECT 'field_found', 'no_such_field:height', 1, 1
               UNION ALL SELECT 'table_found', 'no_such_table:visit', 1, 1""",
            "person",
            "meas",
        ),
    ),
    "dq_cross_model_ids": Query(
        lambda m: quality.dq_cross_model_ids(m.person_defects, m.flat_patient_defects),
        _rows(_CROSS_ROWS, *_CROSS),
    ),
    "dq_cross_model_birthdate": Query(
        lambda m: quality.dq_cross_model_birthdate(m.person_defects, m.flat_patient_defects),
        _check(
            "cross_model_birthdate", "birth_date", _WRONG_BIRTH, "count(*)", _PAIRS, *_CROSS
        ),
    ),
    "cross_model_report": Query(
        lambda m: quality.cross_model_report(m.person_defects, m.flat_patient_defects),
        _rows(
            f"""{_CROSS_ROWS}
                UNION ALL SELECT 'cross_model_birthdate', 'birth_date', {_WRONG_BIRTH}, count(*)
                       {_PAIRS}
                UNION ALL SELECT 'cross_model_size', 'omop_persons', 0,
                       (SELECT count(DISTINCT person_id) FROM person_d)
                UNION ALL SELECT 'cross_model_size', 'fhir_patients', 0,
                       (SELECT count(DISTINCT person_id_omop) FROM flat_d)
                UNION ALL SELECT 'cross_model_size', 'matched_records', 0, count(*) {_PAIRS}""",
            *_CROSS,
        ),
    ),
    "dq_gender_consistency": Query(
        lambda m: quality.dq_gender_consistency(
            m.person.withColumn(
                "gender_concept_id",
                F.when(F.col("person_id") % 59 == 0, 8507).otherwise(F.col("gender_concept_id")),
            ),
            m.flat_patient,
        ),
        _check(
            "gender_consistency", "gender",
            "count(*) FILTER (WHERE gender = 'female' AND person_id % 59 = 0)", "count(*)",
            "FROM person JOIN pat ON person_id = c_custkey", "person", "pat",
        ),
    ),
    "dq_row_count_match": Query(
        lambda m: quality.dq_row_count_match(m.stg_patient, m.stg_encounter, "patients=encounters"),
        """SELECT 'row_count_match' AS "check", 'patients=encounters' AS subject,
                  abs(p - o) AS violations, p AS total, p = o AS passed
           FROM (SELECT (SELECT count(*) FROM customer) AS p, (SELECT count(*) FROM orders) AS o)""",
    ),
    "dq_required_columns": Query(
        lambda m: quality.dq_required_columns(
            m.person, ["person_id", "gender_concept_id", "year_of_birth", "height"]
        ),
        _rows(
            """SELECT 'required_columns' AS "check", c AS subject,
                      CASE WHEN c = 'height' THEN count(*) ELSE 0 END AS v, count(*) AS n
               FROM person, (VALUES ('person_id'), ('gender_concept_id'), ('year_of_birth'),
                                    ('height')) t(c) GROUP BY c""",
            "person",
        ),
    ),
    "dq_expected_codes": Query(
        lambda m: quality.dq_expected_codes(m.person, "gender_concept_id", [8507, 8532]),
        _check(
            "expected_codes", "gender_concept_id",
            "count(DISTINCT gender_concept_id) FILTER (WHERE gender_concept_id NOT IN (8507, 8532))",
            "count(DISTINCT gender_concept_id)", "FROM person", "person",
        ),
    ),
    "dq_referential_integrity": Query(
        lambda m: quality.dq_referential_integrity(
            {
                "observation": m.stg_observation,
                "encounter": m.stg_encounter_defects,
                "patient": m.stg_patient_defects,
            },
            [
                ("observation", "encounter_id", "encounter", "encounter_id"),
                ("observation", "patient_id", "patient", "patient_id"),
                ("encounter", "patient_id", "patient", "patient_id"),
            ],
        ),
        _rows(
            """SELECT 'referential_integrity' AS "check",
                      'observation.encounter_id->encounter.encounter_id' AS subject,
                      count(*) FILTER (WHERE l_orderkey % 101 = 0) AS v, count(*) AS n FROM obs
               UNION ALL SELECT 'referential_integrity',
                      'observation.patient_id->patient.patient_id',
                      count(*) FILTER (WHERE o_custkey % 97 = 0), count(*) FROM obs
               UNION ALL SELECT 'referential_integrity',
                      'encounter.patient_id->patient.patient_id',
                      count(*) FILTER (WHERE o_custkey % 97 = 0), count(*) FROM enc""",
            "obs",
            "enc",
        ),
    ),
    "dq_terminology": Query(
        lambda m: quality.dq_terminology(m.condition, "condition_concept_id"),
        _check(
            "terminology", "condition_concept_id",
            "count(*) FILTER (WHERE condition_concept_id = 317009)", "count(*)", "FROM cond",
            "cond",
        ),
    ),
    "dq_drift": Query(
        dq_drift,
        sql(
            f"""SELECT 'distribution_drift' AS "check", 'age of ' || gender AS subject,
                       (max(abs(known - share)) > {_MAX_GAP})::BIGINT AS violations, any_value(n) AS total,
                       max(abs(known - share)) <= {_MAX_GAP} AS passed
                FROM (SELECT gender, share, count(*) AS n,
                             count(*) FILTER (WHERE 2025 - year(birth_date) <= point) / count(*) AS known
                      FROM pat, (VALUES {_POINTS}) AS points(point, share) GROUP BY gender, share)
                GROUP BY gender""",
            "pat",
        ),
    ),
    "dq_distribution": Query(
        lambda m: quality.dq_distribution(_ages(m), "age"),
        sql(
            """SELECT "check", 'age' AS subject, v::BIGINT AS violations, n AS total,
                      v = 0 AS passed
               FROM (SELECT unnest(['distribution_mean', 'distribution_stddev',
                                    'distribution_bounds']) AS "check",
                            unnest([CASE WHEN abs(avg(a) - 50) > 10 THEN 1 ELSE 0 END,
                                    CASE WHEN abs(stddev_samp(a) - 15) > 3 THEN 1 ELSE 0 END,
                                    count(*) FILTER (WHERE a < 0 OR a > 100)]) AS v,
                            count(*) AS n
                     FROM (SELECT 2025 - year(birth_date) AS a FROM pat))""",
            "pat",
        ),
    ),
    "distribution_summary": Query(
        lambda m: quality.distribution_summary(_ages(m), "age"),
        sql(
            """SELECT count(*) AS n, round(avg(a), 4) AS mean,
                      round(stddev_samp(a), 4) AS stddev, min(a) AS min, max(a) AS max,
                      count(*) FILTER (WHERE a < 0 OR a > 100) AS outside
               FROM (SELECT 2025 - year(birth_date) AS a FROM pat)""",
            "pat",
        ),
    ),
    "dq_anomaly_share": Query(
        lambda m: quality.dq_anomaly_share(_ages(m), "centenarians", F.col("age") >= 100),
        sql(
            """SELECT 'anomaly_share' AS "check", 'centenarians' AS subject, v AS violations,
                      n AS total, v <= n * 0.01 AS passed
               FROM (SELECT count(*) FILTER (WHERE 2025 - year(birth_date) >= 100) AS v,
                            count(*) AS n FROM pat)""",
            "pat",
        ),
    ),
    "dq_freshness": Query(
        lambda m: quality.dq_freshness(m.stg_encounter, "period_start", "2002-01-05 00:00:00"),
        _check(
            "freshness", "period_start",
            """CASE WHEN max(period_start) < TIMESTAMP '2002-01-05 00:00:00' - INTERVAL 7 DAY
                    THEN 1 ELSE 0 END""",
            "count(*)", "FROM enc", "enc",
        ),
    ),
    "slo_success_rate": Query(
        lambda m: quality.slo_success_rate(run_log(m.spark, m.sf_dir)),
        sql(
            """SELECT date_trunc('month', started_at)::DATE AS month, count(*) AS runs,
                      round(count(*) FILTER (WHERE status = 'success') / count(*), 6)
                          AS success_rate,
                      round(count(*) FILTER (WHERE status = 'success') / count(*), 6) >= 0.99
                          AS met
               FROM runs GROUP BY 1""",
            "runs",
        ),
    ),
    "slo_duration": Query(
        lambda m: quality.slo_duration(run_log(m.spark, m.sf_dir)),
        sql(
            """SELECT date_trunc('month', started_at)::DATE AS month, count(*) AS runs,
                      count(*) FILTER (WHERE s >= 1200) AS late_runs,
                      round(max(s) / 60, 4) AS max_minutes,
                      count(*) FILTER (WHERE s >= 1200) = 0 AS met
               FROM (SELECT *, date_diff('second', started_at, ended_at) AS s FROM runs)
               GROUP BY 1""",
            "runs",
        ),
    ),
    "dq_report": Query(
        dq_report,
        sql(
            """SELECT "check", subject, v::BIGINT AS violations, n::BIGINT AS total,
                      v = 0 AS passed, 'run-7' AS run_id
               FROM (SELECT 'not_null' AS "check", 'encounter_id' AS subject, 0 AS v,
                            count(*) AS n FROM enc
                     UNION ALL SELECT 'not_null', 'period_end',
                            count(*) FILTER (WHERE period_end IS NULL), count(*) FROM enc
                     UNION ALL SELECT 'unique', 'patient_id', 0, count(*) FROM pat
                     UNION ALL SELECT 'terminology', 'condition_concept_id',
                            count(*) FILTER (WHERE condition_concept_id = 317009), count(*)
                     FROM cond)""",
            "enc",
            "pat",
            "cond",
        ),
    ),
    "expected_outputs": Query(
        expected_outputs,
        """SELECT o AS output, f AS found, f AS has_bytes
           FROM (VALUES ('person.parquet', true), ('condition_occurrence.parquet', true),
                        ('measurement.parquet', false)) t(o, f)""",
    ),
}
