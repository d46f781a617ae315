"""Staging, marts, joins and lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from medloom.functions.documents import extension_value, path, ref_id
from medloom.functions.identity import tokenize
from medloom.operators import joins, lineage, marts, staging
from medloom.operators.validation import cast_failures
from medloom.plans.catalog.base import Query, sql
from medloom.schemas import ABNORMAL_INTERPRETATIONS, OBSERVATION_CATEGORIES, PERSON_ID_URL
from medloom.session import scratch_dir
from medloom.sources.history import History

_TS = "TIMESTAMP '2025-01-01 00:00:00'"


def _ntz(df):
    return df.withColumn("ingestion_time", F.col("ingestion_time").cast("timestamp_ntz"))


_STG_PATIENT = """patient_id, active, gender, birth_date, deceased_datetime, name_family,
    name_given, city, state, postal_code, country"""
_STG_ENCOUNTER = """encounter_id, status, class_code, class_display, patient_id,
    patient_display, period_start, period_end, type_code, type_display, type_system,
    service_provider_id, service_provider_display, reason_code, reason_display,
    participant_id, participant_display, location_id, location_display"""
_STG_OBSERVATION = """observation_id, status, category_code, category_display,
    category_system, code, code_display, code_system, patient_id, patient_display,
    encounter_id, effective_datetime, effective_period_start, effective_period_end, issued,
    value_quantity, value_unit, value_system, value_code, value_string, value_boolean,
    value_codeable_code, value_codeable_display, reference_range_low, reference_range_high,
    reference_range_unit, interpretation_code, interpretation_display, performer_id,
    performer_display"""


def _source(name: str) -> str:
    return f"'{name}.ndjson' AS source_file, {_TS} AS ingestion_time"


def _listed(codes: tuple[str, ...]) -> str:
    return ", ".join(f"'{code}'" for code in codes)


# The first kind of value that is there; a null part makes its whole text null.
_DISPLAY = """coalesce(
    if(o.value_quantity = floor(o.value_quantity), o.value_quantity::BIGINT::VARCHAR,
       o.value_quantity::VARCHAR) || ' ' || coalesce(o.value_unit, ''),
    o.value_string, map {true: 'Yes', false: 'No'}[o.value_boolean], o.value_codeable_display)"""
_ABNORMAL = f"""CASE WHEN o.interpretation_code IN ({_listed(ABNORMAL_INTERPRETATIONS)}) THEN true
    WHEN o.value_quantity IS NOT NULL AND o.reference_range_low IS NOT NULL
         AND o.reference_range_high IS NOT NULL
    THEN o.value_quantity < o.reference_range_low OR o.value_quantity > o.reference_range_high
    ELSE false END"""
_CATEGORY = f"""CASE WHEN o.category_code IN ({_listed(OBSERVATION_CATEGORIES)}) THEN o.category_code
    ELSE 'other' END"""


def _merged(m):
    """Patients known from a first run and arriving in a second one.

    The first run knew every second patient by another key, so some keys are on one side only.
    """
    seen = m.stg_patient.select("patient_id", "city", "state")
    key = F.col("patient_id").cast("bigint")

    def stamped(df, day, run):
        ts = F.timestamp_add("HOUR", (key % 24).cast("int"), F.lit(day).cast("timestamp_ntz"))
        return lineage.lineage_columns(df, ts, "fhir", run, model="patient", run_id=run)

    old_id = F.when(key % 2 == 0, F.concat(F.lit("old-"), "patient_id")).otherwise(
        F.col("patient_id")
    )
    existing = stamped(seen.withColumn("city", F.lit("before")), "2024-01-01", "run-1")
    return existing.withColumn("patient_id", old_id), stamped(seen, "2024-02-01", "run-2")


def merge_first_seen(m):
    existing, incoming = _merged(m)
    merged = lineage.merge_first_seen(existing, incoming, ["patient_id"])
    return merged.drop("lineage_run_id", "lineage_model", "lineage_env")


def merge_touched_buckets(m):
    """The same merge through a table in buckets: the first run makes it, the second is merged."""
    existing, incoming = _merged(m)
    history = History(m.spark, scratch_dir(m.spark, "history"), ["patient_id"], buckets=32)
    history.merge(existing)
    history.merge(incoming)
    return history.read().drop("lineage_run_id", "lineage_model", "lineage_env")


def lineage_summary(m):
    existing, incoming = _merged(m)
    both = existing.withColumn("lineage_source_origin", F.lit("omop")).unionByName(incoming)
    return lineage.lineage_summary(both, ["patient_id"]).withColumn(
        "sources", F.array_join("sources", "+")
    )


def terminology_join(m):
    concepts = m.condition.select("condition_concept_id").distinct()
    core = concepts.filter(F.col("condition_concept_id") != 317009)
    joined = joins.terminology_join(m.condition, "condition_concept_id", core)
    return joined.select("condition_occurrence_id", "condition_concept_id", "in_set")


def cross_org_references(m):
    shifted = F.concat(
        F.lit("org-"),
        ((F.substring("service_provider_id", 5, 9).cast("int") + 1) % 5).cast("string"),
    )
    wrong = F.col("encounter_id").cast("bigint") % 97 == 0
    facts = m.stg_encounter.select(
        "encounter_id",
        "patient_id",
        F.when(wrong, shifted).otherwise(F.col("service_provider_id")).alias("organization_id"),
    )
    patients = m.tenant_raw("patients").select(path(".id").alias("patient_id"), "organization_id")
    return joins.cross_org_references(facts, patients)


def patient_identifiers(m):
    found = staging.patient_identifiers(m.raw("patients"))
    other = F.col("other_ids")[0]
    return found.select(
        "patient_id",
        "mrn",
        "ssn",
        other["system"].alias("other_system"),
        other["value"].alias("other_value"),
        F.size("other_ids").cast("bigint").alias("other_count"),
        "family_name",
        F.array_join("given_names", " ").alias("given_names"),
        "birth_date",
        "gender",
    )


def _fhir(kind):
    """Back to documents; shown by the paths a reader would use."""

    def run(m):
        docs = {
            "patient": lambda: staging.to_fhir_patient(
                m.stg_patient.withColumn("updated_at", F.lit("2024-03-01 10:00:00").cast("timestamp_ntz"))
            ),
            "encounter": lambda: staging.to_fhir_encounter(m.stg_encounter),
            "observation": lambda: staging.to_fhir_observation(m.stg_observation),
        }[kind]()
        return docs.select("id", "value")

    return run


_MERGED = sql(
    """SELECT patient_id, city, state,
                      TIMESTAMP '2024-02-01 00:00:00' + to_hours(c_custkey % 24)
                          AS lineage_last_updated_ts,
                      CASE WHEN c_custkey % 2 = 1 THEN TIMESTAMP '2024-01-01 00:00:00'
                           ELSE TIMESTAMP '2024-02-01 00:00:00' END + to_hours(c_custkey % 24)
                          AS lineage_first_seen_ts,
                      'run-2' AS pipeline_run_id, 'fhir' AS lineage_source_origin FROM pat
               UNION ALL
               SELECT 'old-' || patient_id, 'before', state,
                      TIMESTAMP '2024-01-01 00:00:00' + to_hours(c_custkey % 24),
                      TIMESTAMP '2024-01-01 00:00:00' + to_hours(c_custkey % 24),
                      'run-1', 'fhir' FROM pat WHERE c_custkey % 2 = 0""",
    "pat",
)

_API_OBSERVATION = sql(
    f"""SELECT o.observation_id, o.status, o.category_code, o.category_display, o.code,
               o.code_display, o.code_system, o.patient_id, p.full_name AS patient_name,
               o.encounter_id, e.class_display AS encounter_class,
               o.effective_datetime, o.effective_period_start, o.effective_period_end,
               o.issued, o.value_quantity, o.value_unit, o.value_string,
               o.value_boolean, o.value_codeable_code, o.value_codeable_display,
               o.reference_range_low, o.reference_range_high, o.reference_range_unit,
               o.interpretation_code, o.interpretation_display, o.performer_id,
               o.performer_display, {_source('observations')},
               {_DISPLAY} AS value_display, {_ABNORMAL} AS is_abnormal,
               {_CATEGORY} AS category_type
        FROM obs o LEFT JOIN api_pat p ON o.patient_id = p.patient_id
                   LEFT JOIN enc e ON o.encounter_id = e.encounter_id""",
    "api_pat",
    "enc",
    "obs",
)

QUERIES: dict[str, Query] = {
    "stg_patient": Query(
        lambda m: _ntz(m.stg_patient),
        sql(f"SELECT {_STG_PATIENT}, {_source('patients')} FROM pat", "pat"),
    ),
    "stg_encounter": Query(
        lambda m: _ntz(m.stg_encounter),
        sql(f"SELECT {_STG_ENCOUNTER}, {_source('encounters')} FROM enc", "enc"),
    ),
    "stg_observation": Query(
        lambda m: _ntz(m.stg_observation),
        sql(f"SELECT {_STG_OBSERVATION}, {_source('observations')} FROM obs", "obs"),
    ),
    "flatten_patient": Query(lambda m: m.flat_patient, sql("SELECT * FROM flat", "flat")),
    "extension_value": Query(
        lambda m: m.raw("patients").select(
            path(".id").alias("patient_id"), extension_value(PERSON_ID_URL).alias("person_id")
        ),
        sql("SELECT patient_id, c_custkey AS person_id FROM pat", "pat"),
    ),
    "patient_identifiers": Query(
        patient_identifiers,
        sql(
            """SELECT patient_id, 'MRN' || c_custkey AS mrn,
                      lpad(c_custkey::VARCHAR, 9, '0') AS ssn, 'urn:plan' AS other_system,
                      c_mktsegment AS other_value, 1::BIGINT AS other_count,
                      name_family AS family_name, name_given AS given_names,
                      birth_date::VARCHAR AS birth_date, gender
               FROM pat""",
            "pat",
        ),
    ),
    "ref_id": Query(
        lambda m: m.raw("encounters").select(
            path(".id").alias("encounter_id"),
            ref_id(path(".participant[0].individual.reference")).alias("participant_id"),
        ),
        sql("SELECT encounter_id, participant_id FROM enc", "enc"),
    ),
    "stg_person": Query(
        lambda m: staging.stg_person(m.person), sql("SELECT * FROM person", "person")
    ),
    "stg_condition_occurrence": Query(
        lambda m: staging.stg_condition_occurrence(m.condition),
        sql("SELECT * FROM cond", "cond"),
    ),
    "stg_measurement": Query(
        lambda m: staging.stg_measurement(m.measurement), sql("SELECT * FROM meas", "meas")
    ),
    "to_fhir_patient": Query(
        _fhir("patient"),
        sql(
            """SELECT patient_id AS id, '{"resourceType":"Patient","id":"' || patient_id
                   || '","gender":"' || gender || '","birthDate":"' || birth_date::VARCHAR
                   || '","meta":{"lastUpdated":"2024-03-01T10:00:00"}}' AS value FROM pat""",
            "pat",
        ),
    ),
    "to_fhir_encounter": Query(
        _fhir("encounter"),
        sql(
            """SELECT encounter_id AS id, '{"resourceType":"Encounter","id":"' || encounter_id
                   || '","status":"' || status || '","subject":{"reference":"Patient/'
                   || patient_id || '"},"period":{"start":"'
                   || strftime(period_start, '%Y-%m-%dT%H:%M:%S') || '"'
                   || coalesce(',"end":"' || strftime(period_end, '%Y-%m-%dT%H:%M:%S') || '"', '')
                   || '}}' AS value FROM enc""",
            "enc",
        ),
    ),
    "to_fhir_observation": Query(
        _fhir("observation"),
        sql(
            """SELECT observation_id AS id, '{"resourceType":"Observation","id":"'
                   || observation_id || '","status":"' || status
                   || '","code":{"coding":[{"system":"http://loinc.org","code":"' || code
                   || '","display":"' || code_display || '"}]},"subject":{"reference":"Patient/'
                   || patient_id || '"}' || coalesce(',"valueQuantity":{"value":'
                   || value_quantity::VARCHAR || ',"unit":"' || value_unit || '"}', '')
                   || '}' AS value FROM obs""",
            "obs",
        ),
    ),
    "lineage_columns": Query(
        lambda m: lineage.lineage_columns(
            m.person.select("person_id", "gender_concept_id"),
            F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"),
            source_origin="omop",
            pipeline_run_id="dev-run",
            model="person",
            run_id="run-1",
            env="test",
        ),
        sql(
            f"""SELECT person_id, gender_concept_id, {_TS} AS lineage_last_updated_ts,
                      {_TS} AS lineage_first_seen_ts, 'dev-run' AS pipeline_run_id,
                      'omop' AS lineage_source_origin, 'run-1' AS lineage_run_id,
                      'person' AS lineage_model, 'test' AS lineage_env FROM person""",
            "person",
        ),
    ),
    "api_patient": Query(
        lambda m: m.api_patient,
        sql(
            f"""SELECT {_STG_PATIENT}, {_source('patients')}, full_name, age, is_deceased
                FROM api_pat""",
            "api_pat",
        ),
    ),
    "api_encounter": Query(
        lambda m: m.api_encounter,
        sql(
            f"""SELECT e.encounter_id, e.status, e.class_code, e.class_display, e.patient_id,
                       p.full_name AS patient_name, p.gender AS patient_gender, e.period_start,
                       e.period_end, e.type_code, e.type_display, e.type_system,
                       e.service_provider_id, e.service_provider_display, e.reason_code,
                       e.reason_display, e.participant_id, e.participant_display,
                       e.location_id, e.location_display, {_source('encounters')},
                       date_diff('hour', e.period_start, e.period_end) AS duration_hours,
                       e.status IN ('in-progress','arrived','triaged','onleave') AS is_active
                FROM enc e LEFT JOIN api_pat p ON e.patient_id = p.patient_id""",
            "api_pat",
            "enc",
        ),
    ),
    "api_observation": Query(lambda m: m.api_observation, _API_OBSERVATION),
    "api_observation_colocated": Query(lambda m: m.api_observation_colocated, _API_OBSERVATION),
    "age_years": Query(
        lambda m: m.api_patient.select("patient_id", "age"),
        sql("SELECT patient_id, age FROM api_pat", "api_pat"),
    ),
    "encounter_duration_hours": Query(
        lambda m: m.api_encounter.groupBy("duration_hours").agg(
            F.count(F.lit(1)).alias("encounters")
        ),
        sql(
            """SELECT date_diff('hour', period_start, period_end) AS duration_hours,
                      count(*) AS encounters FROM enc GROUP BY 1""",
            "enc",
        ),
    ),
    "encounter_is_active": Query(
        lambda m: m.api_encounter.groupBy("status", "is_active").agg(
            F.count(F.lit(1)).alias("encounters")
        ),
        sql(
            """SELECT status, status IN ('in-progress','arrived','triaged','onleave')
                          AS is_active, count(*) AS encounters FROM enc GROUP BY 1, 2""",
            "enc",
        ),
    ),
    "observation_value_display": Query(
        lambda m: m.api_observation.groupBy("value_display").agg(
            F.count(F.lit(1)).alias("observations")
        ),
        sql(
            f"""SELECT {_DISPLAY} AS value_display, count(*) AS observations
                FROM obs o GROUP BY 1""",
            "obs",
        ),
    ),
    "observation_is_abnormal": Query(
        lambda m: m.api_observation.groupBy("interpretation_code", "is_abnormal").agg(
            F.count(F.lit(1)).alias("observations")
        ),
        sql(
            f"""SELECT interpretation_code, {_ABNORMAL} AS is_abnormal,
                       count(*) AS observations FROM obs o GROUP BY 1, 2""",
            "obs",
        ),
    ),
    "observation_category_type": Query(
        lambda m: m.api_observation.groupBy("category_code", "category_type").agg(
            F.count(F.lit(1)).alias("observations")
        ),
        sql(
            f"""SELECT category_code, {_CATEGORY} AS category_type,
                       count(*) AS observations FROM obs o GROUP BY 1, 2""",
            "obs",
        ),
    ),
    "fhir_omop_birth_join": Query(
        lambda m: joins.fhir_omop_birth_join(m.person_defects, m.flat_patient_defects),
        sql(
            """SELECT person_id, year_of_birth, month_of_birth, day_of_birth, person_id_omop,
                      birth_date
               FROM person_d JOIN flat_d ON person_id = person_id_omop""",
            "person_d",
            "flat_d",
        ),
    ),
    "missing_in_fhir": Query(
        lambda m: joins.missing_in_fhir(m.person_defects, m.flat_patient_defects),
        sql(
            """SELECT DISTINCT person_id FROM person_d WHERE person_id NOT IN
               (SELECT person_id_omop FROM flat_d WHERE person_id_omop IS NOT NULL)""",
            "person_d",
            "flat_d",
        ),
    ),
    "missing_in_omop": Query(
        lambda m: joins.missing_in_omop(m.person_defects, m.flat_patient_defects),
        sql(
            """SELECT DISTINCT person_id_omop AS person_id FROM flat_d
               WHERE person_id_omop NOT IN (SELECT person_id FROM person_d)""",
            "person_d",
            "flat_d",
        ),
    ),
    "fhir_omop_condition_top": Query(
        lambda m: joins.fhir_omop_condition_top(m.stg_patient, m.person, m.condition),
        sql(
            """SELECT * FROM (WITH per_person AS (
                   SELECT person_id, count(*) AS conditions FROM cond GROUP BY person_id),
               both_models AS (
                   SELECT patient_id, name_family, name_given, year_of_birth,
                          coalesce(conditions, 0) AS conditions
                   FROM person LEFT JOIN per_person USING (person_id), pat
                   WHERE patient_id = person_id::VARCHAR)
               SELECT patient_id AS fhir_patient_id, name_family AS family_name,
                      name_given AS given_name, year_of_birth, conditions AS condition_count
               FROM both_models
               QUALIFY row_number() OVER (ORDER BY conditions DESC, patient_id) <= 20)""",
            "pat",
            "person",
            "cond",
        ),
    ),
    "person_conditions": Query(
        lambda m: joins.person_conditions(m.person, m.condition),
        sql(
            """SELECT p.person_id, year_of_birth, gender_concept_id, condition_occurrence_id,
                      condition_concept_id
               FROM person p LEFT JOIN cond c ON p.person_id = c.person_id""",
            "person",
            "cond",
        ),
    ),
    "orphan_records": Query(
        lambda m: joins.orphan_records(
            m.stg_observation.select("observation_id", "encounter_id"),
            m.stg_encounter_defects,
            "encounter_id",
            "encounter_id",
        ),
        sql(
            """SELECT observation_id, encounter_id FROM obs WHERE l_orderkey % 101 = 0
               OR l_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
            "obs",
        ),
    ),
    "cross_org_references": Query(
        cross_org_references,
        sql(
            """SELECT e.encounter_id, e.patient_id,
                      'org-' || ((substr(service_provider_id, 5)::INTEGER + 1) % 5)
                          AS organization_id, p.organization_id AS patient_organization_id
               FROM enc e JOIN pat p ON e.patient_id = p.patient_id
               WHERE e.o_orderkey % 97 = 0""",
            "pat",
            "enc",
        ),
    ),
    "terminology_join": Query(
        terminology_join,
        sql(
            """SELECT condition_occurrence_id, condition_concept_id,
                      condition_concept_id <> 317009 AS in_set FROM cond""",
            "cond",
        ),
    ),
    "patient_conditions_risk": Query(
        lambda m: marts.patient_conditions_risk(m.person, m.condition),
        sql(
            """SELECT * FROM (WITH known AS (
                   SELECT person_id, list_distinct(list(condition_concept_id)) AS concepts
                   FROM cond GROUP BY person_id),
               flags AS (
                   SELECT p.person_id, year_of_birth, gender_concept_id,
                          coalesce(len(concepts), 0)::BIGINT AS condition_count,
                          list_transform([201826, 320128, 317009],
                              lambda c: coalesce(list_contains(concepts, c), false)::INTEGER) AS f
                   FROM person AS p LEFT JOIN known USING (person_id))
               SELECT person_id, year_of_birth, gender_concept_id, condition_count,
                      f[1] AS has_diabetes, f[2] AS has_hypertension, f[3] AS has_asthma,
                      ['Low Risk', 'Moderate Risk', 'High Risk', 'High Risk'][list_sum(f)::BIGINT + 1]
                          AS risk_category
               FROM flags)""",
            "person",
            "cond",
        ),
    ),
    "dim_condition": Query(
        lambda m: marts.dim_condition(m.condition),
        sql(
            """SELECT DISTINCT condition_concept_id, condition_name FROM fact""",
            "fact",
        ),
    ),
    "dim_patient": Query(
        lambda m: m.dim_patient,
        sql(
            f"""SELECT *, {_TS} AS lineage_last_updated_ts, {_TS} AS lineage_first_seen_ts,
                       'run-1' AS pipeline_run_id,
                       CASE WHEN patient_id IS NULL THEN 'omop' ELSE 'omop+fhir' END
                           AS lineage_source_origin,
                       'unknown' AS lineage_run_id, 'dim_patient' AS lineage_model,
                       'dev' AS lineage_env
                FROM dim""",
            "dim",
        ),
    ),
    "fact_chronic_condition": Query(
        lambda m: m.fact_chronic, sql("SELECT * FROM fact", "fact")
    ),
    "tokenize": Query(
        lambda m: m.tenant_raw("patients").select(
            path(".id").alias("patient_id"),
            tokenize(path(".id"), F.col("organization_id"), "pepper").alias("patient_token"),
        ),
        sql(
            """SELECT patient_id, sha256(organization_id || ':pepper:' || patient_id)
                          AS patient_token FROM pat""",
            "pat",
        ),
    ),
    "merge_first_seen": Query(merge_first_seen, _MERGED),
    "merge_touched_buckets": Query(merge_touched_buckets, _MERGED),
    "lineage_summary": Query(
        lineage_summary,
        sql(
            """SELECT patient_id,
                      CASE WHEN c_custkey % 2 = 1 THEN TIMESTAMP '2024-01-01 00:00:00'
                           ELSE TIMESTAMP '2024-02-01 00:00:00' END + to_hours(c_custkey % 24)
                          AS first_seen,
                      TIMESTAMP '2024-02-01 00:00:00' + to_hours(c_custkey % 24)
                          AS last_updated,
                      CASE WHEN c_custkey % 2 = 1 THEN 'fhir+omop' ELSE 'fhir' END AS sources
               FROM pat
               UNION ALL
               SELECT 'old-' || patient_id,
                      TIMESTAMP '2024-01-01 00:00:00' + to_hours(c_custkey % 24),
                      TIMESTAMP '2024-01-01 00:00:00' + to_hours(c_custkey % 24), 'omop'
               FROM pat WHERE c_custkey % 2 = 0""",
            "pat",
        ),
    ),
    "cast_failures": Query(
        lambda m: cast_failures(
            m.raw("observations"),
            {".valueQuantity.value": "double", ".id": "bigint", ".effectiveDateTime": "date"},
        ),
        sql(
            """SELECT '.valueQuantity.value' AS path, 0::BIGINT AS failures
               UNION ALL SELECT '.id', count(*) FROM obs
               UNION ALL SELECT '.effectiveDateTime', 0""",
            "obs",
        ),
    ),
}
