"""Query entries and the SQL side of the derived inputs."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame

from medloom.plans.clinical import Clinical


class Query(NamedTuple):
    run: Callable[[Clinical], DataFrame]
    sql: str | None = None


# The inputs of fixtures.py, straight from the relational tables.
_INPUTS: dict[str, str] = {
    "pat": """
        SELECT c_custkey, c_custkey::VARCHAR AS patient_id,
               CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal >= 0 END AS active,
               CASE c_custkey % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'female'
                    WHEN 2 THEN 'other' ELSE 'unknown' END AS gender,
               DATE '1920-01-01' + ((c_custkey * 37) % 36500)::INTEGER AS birth_date,
               CASE WHEN c_custkey % 10 = 0 THEN TIMESTAMP '2024-06-01 00:00:00' END
                   AS deceased_datetime,
               CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS name_family,
               CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS name_given,
               n_name AS city, r_name AS state,
               lpad(c_custkey::VARCHAR, 5, '0') AS postal_code, 'US' AS country,
               'org-' || (c_nationkey % 5) AS organization_id, c_mktsegment
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
                      LEFT JOIN region ON n_regionkey = r_regionkey""",
    "api_pat": """
        SELECT *, name_given || ' ' || name_family AS full_name,
               coalesce(year(deceased_datetime), 2025) - year(birth_date) AS age,
               deceased_datetime IS NOT NULL AS is_deceased
        FROM pat""",
    "enc": """
        SELECT o_orderkey, o_custkey, o_orderkey::VARCHAR AS encounter_id,
               CASE o_orderstatus WHEN 'O' THEN 'in-progress' WHEN 'F' THEN 'finished'
                    ELSE 'planned' END AS status,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'EMER' WHEN '2' THEN 'IMP'
                    ELSE 'AMB' END AS class_code,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'emergency'
                    WHEN '2' THEN 'inpatient' ELSE 'ambulatory' END AS class_display,
               o_custkey::VARCHAR AS patient_id, 'Patient ' || o_custkey AS patient_display,
               o_orderdate + to_minutes(o_orderkey % 60) AS period_start,
               CASE WHEN o_orderstatus <> 'O' THEN
                    o_orderdate + to_minutes(o_orderkey % 60 + (o_orderkey % 72) * 50) END
                   AS period_end,
               'T' || (o_orderkey % 3) AS type_code, 'Type ' || (o_orderkey % 3) AS type_display,
               'http://snomed.info/sct' AS type_system,
               'org-' || (c_nationkey % 5) AS service_provider_id,
               'Clinic' AS service_provider_display,
               CASE WHEN o_orderkey % 6 <> 0 THEN 'R' || (o_orderkey % 4) END AS reason_code,
               CASE WHEN o_orderkey % 6 <> 0 THEN 'Reason ' || (o_orderkey % 4) END
                   AS reason_display,
               (o_orderkey % 50)::VARCHAR AS participant_id,
               'Dr ' || (o_orderkey % 50) AS participant_display,
               (o_orderkey % 20)::VARCHAR AS location_id,
               'Ward ' || (o_orderkey % 20) AS location_display
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "obs": """
        SELECT l_orderkey, o_custkey,
               l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
                   || strftime(l_shipdate, '%Y%m%d') || '-'
                   || round(l_extendedprice * 100)::BIGINT AS observation_id,
               CASE WHEN l_linestatus = 'F' THEN 'final' ELSE 'preliminary' END AS status,
               cat AS category_code, upper(cat) AS category_display,
               'urn:category' AS category_system,
               CASE l_partkey % 3 WHEN 0 THEN '2339-0' WHEN 1 THEN '8867-4'
                    ELSE '39156-5' END AS code,
               CASE l_partkey % 3 WHEN 0 THEN 'Glucose' WHEN 1 THEN 'Heart rate'
                    ELSE 'BMI' END AS code_display,
               'http://loinc.org' AS code_system,
               o_custkey::VARCHAR AS patient_id, NULL::VARCHAR AS patient_display,
               l_orderkey::VARCHAR AS encounter_id,
               CASE WHEN l_partkey % 10 <> 0 THEN l_shipdate END AS effective_datetime,
               CASE WHEN l_partkey % 10 = 0 THEN l_shipdate END AS effective_period_start,
               CASE WHEN l_partkey % 10 = 0 THEN l_shipdate + INTERVAL 1 DAY END
                   AS effective_period_end,
               l_shipdate + INTERVAL 1 DAY AS issued,
               CASE WHEN l_linenumber % 4 = 0 THEN l_quantity END AS value_quantity,
               CASE WHEN l_linenumber % 4 = 0 THEN 'mg/dL' END AS value_unit,
               CASE WHEN l_linenumber % 4 = 0 THEN 'http://unitsofmeasure.org' END
                   AS value_system,
               CASE WHEN l_linenumber % 4 = 0 THEN 'mg/dL' END AS value_code,
               CASE WHEN l_linenumber % 4 = 1 THEN l_returnflag END AS value_string,
               CASE WHEN l_linenumber % 4 = 2 THEN l_linestatus = 'F' END AS value_boolean,
               CASE WHEN l_linenumber % 4 = 3 THEN l_returnflag END AS value_codeable_code,
               CASE WHEN l_linenumber % 4 = 3 THEN 'Flag ' || l_returnflag END
                   AS value_codeable_display,
               CASE WHEN l_suppkey % 10 NOT IN (0, 5, 7) THEN 10.0::DOUBLE END AS reference_range_low,
               CASE WHEN l_suppkey % 10 NOT IN (0, 3, 5) THEN 40.0::DOUBLE END AS reference_range_high,
               CASE WHEN l_suppkey % 10 NOT IN (0, 5, 7) THEN 'mg/dL' END AS reference_range_unit,
               CASE l_returnflag WHEN 'R' THEN 'H' WHEN 'A' THEN 'L' END
                   AS interpretation_code,
               CASE l_returnflag WHEN 'R' THEN 'Flag H' WHEN 'A' THEN 'Flag L' END
                   AS interpretation_display,
               l_suppkey::VARCHAR AS performer_id, 'Dr ' || l_suppkey AS performer_display,
               'org-' || (c_nationkey % 5) AS organization_id
        FROM (SELECT *, CASE (l_partkey + l_suppkey) % 9 WHEN 0 THEN 'vital-signs'
                     WHEN 1 THEN 'laboratory' WHEN 2 THEN 'imaging' WHEN 3 THEN 'procedure'
                     WHEN 4 THEN 'survey' WHEN 5 THEN 'exam' WHEN 6 THEN 'therapy'
                     WHEN 7 THEN 'activity' ELSE 'social-history' END AS cat FROM lineitem)
             LEFT JOIN orders ON l_orderkey = o_orderkey
             LEFT JOIN customer ON o_custkey = c_custkey""",
    "person": """
        SELECT c_custkey AS person_id,
               CASE c_custkey % 4 WHEN 0 THEN 8507 WHEN 1 THEN 8532 ELSE 0 END::BIGINT
                   AS gender_concept_id,
               year(born) AS year_of_birth, month(born) AS month_of_birth,
               day(born) AS day_of_birth, born::VARCHAR AS birth_datetime,
               (8515 + c_nationkey % 3)::BIGINT AS race_concept_id,
               38003564::BIGINT AS ethnicity_concept_id, c_name AS person_source_value,
               CASE c_custkey % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN 'other'
                    ELSE 'unknown' END AS gender_source_value,
               'none' AS race_source_value, 'none' AS ethnicity_source_value,
               '2025-01-01T00:00:00Z' AS _ingestion_ts
        FROM (SELECT *, DATE '1920-01-01' + ((c_custkey * 37) % 36500)::INTEGER AS born
              FROM customer)""",
    "cond": """
        SELECT o_orderkey::VARCHAR AS condition_occurrence_id, o_custkey AS person_id,
               CASE o_orderkey % 4 WHEN 0 THEN 201826 WHEN 1 THEN 320128 WHEN 2 THEN 317009
                    ELSE 201254 END::BIGINT AS condition_concept_id,
               strftime(o_orderdate, '%Y-%m-%d') AS condition_start_date,
               strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS condition_start_datetime,
               32020::BIGINT AS condition_type_concept_id,
               CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END AS visit_occurrence_id
        FROM orders""",
    "meas": """
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
                   || strftime(l_shipdate, '%Y%m%d') || '-'
                   || round(l_extendedprice * 100)::BIGINT AS measurement_id,
               o_custkey AS person_id,
               CASE l_partkey % 3 WHEN 0 THEN 3004501 WHEN 1 THEN 3012888
                    ELSE 3038553 END::BIGINT AS measurement_concept_id,
               strftime(l_shipdate, '%Y-%m-%d') AS measurement_date,
               strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS measurement_datetime,
               44818702::BIGINT AS measurement_type_concept_id, l_quantity AS value_as_number,
               8840::BIGINT AS unit_concept_id, l_orderkey AS visit_occurrence_id
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "flat": """
        SELECT patient_id, c_custkey AS person_id_omop, coalesce(active, true) AS active,
               name_family AS family_name, name_given AS given_name,
               birth_date::VARCHAR AS birth_date, gender,
               CASE WHEN deceased_datetime IS NOT NULL THEN '2024-06-01T00:00:00Z' END
                   AS deceased_datetime,
               CASE WHEN c_custkey % 3 = 0 THEN 'en' END AS language, country, postal_code,
               city, state,
               CASE WHEN c_custkey % 13 = 0 THEN 'unknown' ELSE 'synthetic' END
                   AS synthetic_source,
               '2025-01-01T00:00:00Z' AS ingestion_timestamp,
               '2025-01-01T00:00:00Z' AS fhir_ingestion_ts
        FROM pat""",
    "flat_d": """
        SELECT * REPLACE (
               CASE WHEN person_id_omop % 53 = 0 THEN (birth_date::DATE + 1)::VARCHAR
                    ELSE birth_date END AS birth_date,
               CASE WHEN person_id_omop % 97 = 0 THEN -person_id_omop - 1
                    ELSE person_id_omop END AS person_id_omop)
        FROM flat""",
    "person_d": """
        SELECT * REPLACE (CASE WHEN person_id % 89 = 0 THEN person_id + 1000000000000
                          ELSE person_id END AS person_id)
        FROM person""",
    "dim": """
        SELECT person_id, patient_id,
               CASE gender_concept_id WHEN 8507 THEN 'male' WHEN 8532 THEN 'female'
                    ELSE 'unknown' END AS gender,
               year_of_birth, pat.birth_date, deceased_datetime IS NOT NULL AS is_deceased,
               city, state
        FROM person JOIN pat ON person_id = c_custkey""",
    "fact": """
        SELECT condition_occurrence_id, person_id, condition_concept_id,
               CASE condition_concept_id WHEN 201826 THEN 'Type 2 Diabetes'
                    WHEN 320128 THEN 'Essential Hypertension' WHEN 317009 THEN 'Asthma'
                    ELSE 'Other' END AS condition_name,
               condition_start_date, condition_start_datetime,
               condition_concept_id IN (201826, 320128, 201254) AS is_chronic
        FROM cond WHERE person_id IN (SELECT person_id FROM person)""",
    "ev": """
        SELECT event_id, ts, event_type, value,
               ts + to_seconds(event_id % 600) AS ingested_at, 'job-' || user_id AS job_id,
               CASE WHEN event_type IN ('view', 'signup') THEN 'accepted'
                    WHEN event_type = 'click' THEN 'processing'
                    WHEN event_type = 'purchase' THEN 'completed' ELSE 'failed' END AS status
        FROM events""",
    "runs": """
        SELECT 'run-' || event_id AS run_id, ts AS started_at,
               ts + to_seconds(event_id % 1500) AS ended_at,
               CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status
        FROM events""",
    "req": """
        SELECT o_orderkey, o_custkey, 'req-' || o_orderkey AS request_id,
               'org-' || (c_nationkey % 5) AS organization_id,
               o_orderdate + to_seconds(o_orderkey % 86400) AS requested_at,
               CASE o_orderkey % 5 WHEN 0 THEN 'transaction' WHEN 1 THEN 'batch'
                    WHEN 2 THEN 'collection' WHEN 3 THEN 'message' ELSE 'document' END AS kind,
               2 + CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 0 END
                 + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS entries
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "req_entry": """
        SELECT request_id, o_orderkey, organization_id, requested_at, t AS resource_type, id,
               row_number() OVER (PARTITION BY request_id ORDER BY pos) - 1 AS entry_position
        FROM (
            SELECT *, 1 AS pos, 'Patient' AS t, o_custkey::VARCHAR AS id FROM req
            UNION ALL SELECT *, 2, 'Encounter', o_orderkey::VARCHAR FROM req
            UNION ALL SELECT *, 3, 'Observation', o_orderkey || '-a' FROM req
                WHERE o_orderkey % 3 = 0
            UNION ALL SELECT *, 4, 'Observation', o_orderkey || '-b' FROM req
                WHERE o_orderkey % 3 = 0
            UNION ALL SELECT *, 5, 'Unknown', o_orderkey::VARCHAR FROM req
                WHERE o_orderkey % 7 = 0)
        WHERE o_orderkey % 20 NOT BETWEEN 1 AND 6""",
    "line": """
        SELECT file_no, c_custkey,
               row_number() OVER (PARTITION BY file_no ORDER BY c_custkey) AS row_no,
               CASE WHEN file_no % 4 <> 3 AND c_custkey % 23 = 1 THEN 'bad'
                    WHEN file_no % 4 <> 3 AND c_custkey % 29 = 1 THEN 'list'
                    WHEN file_no % 4 <> 3 AND c_custkey % 31 = 1 THEN 'untyped'
                    WHEN c_custkey % 37 = 1 OR c_custkey % 1200000 < 24 THEN 'blank'
                    WHEN file_no % 4 <> 3 AND c_custkey % 41 = 1 THEN 'bad' ELSE 'ok' END AS kind
        FROM (SELECT c_custkey, c_custkey % 12 + 12 * (c_custkey // 1200000) AS file_no
              FROM customer)""",
    "checked": """
        SELECT file_no, c_custkey, row_no, kind,
               CASE kind WHEN 'bad' THEN 'Invalid JSON on line ' || n
                    WHEN 'list' THEN 'Line ' || n || ' is not a JSON object'
                    WHEN 'untyped' THEN 'Missing ''resourceType'' on line ' || n END AS error
        FROM (SELECT *, row_no - min(row_no) FILTER (WHERE kind <> 'blank')
                     OVER (PARTITION BY file_no) + 1 AS n FROM line)
        WHERE kind <> 'blank'""",
}

_NEEDS = {
    "api_pat": ["pat"],
    "flat": ["pat"],
    "flat_d": ["pat", "flat"],
    "person_d": ["person"],
    "dim": ["pat", "person"],
    "fact": ["cond", "person"],
    "req_entry": ["req"],
    "checked": ["line"],
}


def sql(select: str, *inputs: str) -> str:
    """A statement over the derived inputs it names."""
    names: list[str] = []
    for name in inputs:
        names += [n for n in (*_NEEDS.get(name, []), name) if n not in names]
    if not names:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({_INPUTS[n]})" for n in names) + "\n" + select
