"""Cohort statistics, metrics and set operations."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from medloom.operators import bundles, metrics, sets
from medloom.plans.catalog.base import Query, sql
from medloom.plans.fixtures import AS_OF
from medloom.session import scratch_dir

_NAMES = """CASE condition_concept_id WHEN 201826 THEN 'Type 2 Diabetes'
    WHEN 320128 THEN 'Essential Hypertension' WHEN 317009 THEN 'Asthma' ELSE 'Other' END"""

_SPEC = metrics.MetricSpec(
    name="chronic_condition_count",
    model="fact_chronic_condition",
    type="count",
    expr="condition_concept_id",
    timestamp="condition_start_datetime",
    filters=(("is_chronic", "=", "true"),),
)
_PATIENT_SPEC = metrics.MetricSpec(
    name="patients",
    model="fact_chronic_condition",
    type="count_distinct",
    expr="person_id",
)
_DATED_PATIENT_SPEC = replace(_PATIENT_SPEC, timestamp="condition_start_datetime")


def _incremental(m, spec, dims, grain=None):
    """Metric from states of days that came in two parts; the rows are read once."""
    target = scratch_dir(m.spark, "metric-states")
    day = F.col("condition_start_date").cast("date")
    for part, own in (("first", day < "1997-01-01"), ("then", day >= "1997-01-01")):
        states = metrics.metric_states(spec, m.fact_chronic.where(own), dims)
        states.write.parquet(f"{target}/{part}")
    return metrics.roll_up(m.spark.read.parquet(f"{target}/*"), spec, dims, grain)


_MEASURED = ["measurement_id", "person_id", "value_as_number", "measurement_date"]


def hash_tree(m):
    tree = metrics.hash_tree(m.measurement, _MEASURED, ["measurement_id"], levels=2)
    return tree.select(F.col("range").alias("key_range"), "row_count", "content_hash")


def changed_rows(m):
    """Rows of a version in which some values moved, found by going down both hash trees."""
    moved = F.when(F.col("person_id") % 97 == 0, F.col("value_as_number") + 1)
    after = m.measurement.withColumn("value_as_number", F.coalesce(moved, F.col("value_as_number")))
    key = ["measurement_id"]
    trees = []
    for df in (m.measurement, after):
        target = scratch_dir(m.spark, "hash-tree")
        metrics.hash_tree(df, _MEASURED, key).write.parquet(target)
        trees.append(m.spark.read.parquet(target))
    ranges, _ = metrics.differing_ranges(*trees)
    old, new = (metrics.in_ranges(df, key, ranges).select(*_MEASURED) for df in (m.measurement, after))
    return new.exceptAll(old)


_MEASURED_MD5 = """md5(list_aggregate(list_transform([measurement_id::VARCHAR, person_id::VARCHAR,
    value_as_number::VARCHAR, measurement_date::VARCHAR], lambda c: len(c) || ':' || c), 'string_agg', ''))"""


def _counted(m):
    return m.person.groupBy("race_concept_id").agg(F.count(F.lit(1)).alias("persons"))


QUERIES: dict[str, Query] = {
    "patient_total": Query(
        lambda m: metrics.patient_total(m.person),
        sql("SELECT count(*) AS total_patients FROM person", "person"),
    ),
    "gender_distribution": Query(
        lambda m: metrics.gender_distribution(m.person),
        sql(
            """SELECT * FROM (WITH named(id, name) AS (VALUES (8507, 'Male'), (8532, 'Female')),
                    everyone AS (SELECT count(*) AS n FROM person)
               SELECT coalesce(any_value(name), 'Unknown') AS gender, count(*) AS count,
                      round(100.0 * count(*) / any_value(n), 2) AS percentage
               FROM everyone, person LEFT JOIN named ON id = gender_concept_id
               GROUP BY gender_concept_id)""",
            "person",
        ),
    ),
    "age_decade_histogram": Query(
        lambda m: metrics.age_decade_histogram(m.person, AS_OF),
        sql(
            """SELECT (floor((2025 - year_of_birth) / 10) * 10)::BIGINT AS age_decade,
                      count(*) AS count
               FROM person GROUP BY 1 ORDER BY 1""",
            "person",
        ),
    ),
    "condition_prevalence": Query(
        lambda m: metrics.condition_prevalence(m.condition, m.person),
        sql(
            f"""SELECT * FROM (WITH affected AS (SELECT DISTINCT condition_concept_id, person_id FROM cond),
                     everyone AS (SELECT count(*) AS n FROM person)
                SELECT condition_concept_id, {_NAMES} AS condition_name, count(*) AS patient_count,
                       round(100.0 * count(*) / any_value(n), 2) AS prevalence_pct
                FROM affected, everyone WHERE person_id IS NOT NULL GROUP BY condition_concept_id)""",
            "cond",
            "person",
        ),
    ),
    "measurement_stats": Query(
        lambda m: metrics.measurement_stats(m.measurement),
        sql(
            """SELECT * FROM (WITH named(id, name) AS (VALUES (3004501, 'Glucose (mg/dL)'),
                        (3012888, 'Systolic BP (mmHg)'), (3038553, 'BMI (kg/m²)')),
                    of_kind AS (SELECT measurement_concept_id AS id, list(value_as_number) AS v,
                                       count(*) AS n FROM meas GROUP BY ALL)
               SELECT id AS measurement_concept_id, coalesce(name, 'Other') AS measurement_name,
                      n AS measurement_count, round(list_avg(v), 2) AS avg_value,
                      round(list_min(v), 2) AS min_value, round(list_max(v), 2) AS max_value
               FROM of_kind LEFT JOIN named USING (id))""",
            "meas",
        ),
    ),
    "comorbidity_histogram": Query(
        lambda m: metrics.comorbidity_histogram(m.condition),
        sql(
            """SELECT * FROM (WITH affected AS (SELECT DISTINCT person_id, condition_concept_id FROM cond),
                    sizes AS (SELECT count(condition_concept_id) AS num_conditions
                              FROM affected GROUP BY person_id)
               SELECT num_conditions, count(*) AS patient_count FROM sizes GROUP BY ALL)""",
            "cond",
        ),
    ),
    "condition_counts": Query(
        lambda m: metrics.condition_counts(m.condition),
        sql(
            "SELECT condition_concept_id, count(*) AS condition_count FROM cond GROUP BY 1", "cond"
        ),
    ),
    "condition_counts_by_person": Query(
        lambda m: metrics.condition_counts(m.condition, "person_id"),
        sql("SELECT person_id, count(*) AS condition_count FROM cond GROUP BY 1", "cond"),
    ),
    "condition_counts_by_name": Query(
        lambda m: metrics.condition_counts(m.fact_chronic, "condition_name"),
        sql("SELECT condition_name, count(*) AS condition_count FROM fact GROUP BY 1", "fact"),
    ),
    "deceased_rate": Query(
        lambda m: metrics.deceased_rate(m.raw("patients")),
        sql(
            """SELECT count(*) AS patients, count(deceased_datetime) AS deceased,
                      round(count(deceased_datetime) * 100.0 / count(*), 1) AS deceased_pct
               FROM pat""",
            "pat",
        ),
    ),
    "dataset_statistics": Query(
        lambda m: metrics.dataset_statistics(
            m.raw("patients"), m.person, m.condition, m.measurement
        ),
        sql(
            """SELECT 'records' AS section, 'fhir_patients' AS statistic, count(*) AS value,
                      NULL::DOUBLE AS pct FROM pat
               UNION ALL SELECT 'demographics', 'deceased', count(deceased_datetime),
                      round(count(deceased_datetime) * 100.0 / count(*), 1) FROM pat
               UNION ALL SELECT 'records', 'omop_persons', count(*), NULL FROM person
               UNION ALL SELECT 'demographics', 'male',
                      count(*) FILTER (WHERE gender_concept_id = 8507),
                      round(count(*) FILTER (WHERE gender_concept_id = 8507) * 100.0
                            / count(*), 1) FROM person
               UNION ALL SELECT 'demographics', 'female',
                      count(*) FILTER (WHERE gender_concept_id = 8532),
                      round(count(*) FILTER (WHERE gender_concept_id = 8532) * 100.0
                            / count(*), 1) FROM person
               UNION ALL SELECT 'demographics', 'birth_year_min', min(year_of_birth), NULL
                      FROM person
               UNION ALL SELECT 'demographics', 'birth_year_max', max(year_of_birth), NULL
                      FROM person
               UNION ALL SELECT 'records', 'conditions', count(*), NULL FROM cond
               UNION ALL SELECT 'conditions', n, (SELECT count(*) FROM cond
                      WHERE condition_concept_id = c), NULL
                      FROM (VALUES (201826, 'Type 2 Diabetes'), (320128, 'Essential Hypertension'),
                                   (317009, 'Asthma')) t(c, n)
               UNION ALL SELECT 'records', 'measurements', count(*), NULL FROM meas
               UNION ALL SELECT 'measurements', n, (SELECT count(*) FROM meas
                      WHERE measurement_concept_id = c), NULL
                      FROM (VALUES (3004501, 'Glucose (mg/dL)'), (3012888, 'Systolic BP (mmHg)'),
                                   (3038553, 'BMI (kg/m²)')) t(c, n)""",
            "pat",
            "person",
            "cond",
            "meas",
        ),
    ),
    "metric_patient_count": Query(
        lambda m: metrics.metric_patient_count(m.dim_patient),
        sql("SELECT count(DISTINCT person_id) AS patient_count FROM dim", "dim"),
    ),
    "metric_condition_patients": Query(
        lambda m: metrics.metric_condition_patients(m.fact_chronic),
        sql(
            """SELECT count(DISTINCT person_id) AS chronic_condition_patient_count
               FROM fact WHERE is_chronic""",
            "fact",
        ),
    ),
    "metric_prevalence": Query(
        lambda m: metrics.metric_prevalence(m.fact_chronic, m.dim_patient),
        sql(
            """SELECT count(*) AS patients, count(f.person_id) AS condition_patients,
                      round(count(f.person_id) / count(*), 6) AS prevalence
               FROM dim LEFT JOIN (SELECT DISTINCT person_id FROM fact WHERE is_chronic) f
                    USING (person_id)""",
            "dim",
            "fact",
        ),
    ),
    "metric_prevalence_by_gender": Query(
        lambda m: metrics.metric_prevalence(m.fact_chronic, m.dim_patient, ["gender"], 201826),
        sql(
            """SELECT gender, count(*) AS patients, count(f.person_id) AS condition_patients,
                      round(count(f.person_id) / count(*), 6) AS prevalence
               FROM dim LEFT JOIN (SELECT DISTINCT person_id FROM fact
                                   WHERE is_chronic AND condition_concept_id = 201826) f
                    USING (person_id) GROUP BY gender""",
            "dim",
            "fact",
        ),
    ),
    "metric_diagnosis_rate": Query(
        lambda m: metrics.metric_diagnosis_rate(m.fact_chronic),
        sql(
            """SELECT round(count(*) / count(DISTINCT person_id), 6) AS diagnosis_rate
               FROM fact WHERE is_chronic""",
            "fact",
        ),
    ),
    "metric_condition_count": Query(
        lambda m: metrics.metric_condition_count(m.fact_chronic),
        sql(
            """SELECT person_id, count(*) AS chronic_condition_count
               FROM fact WHERE is_chronic GROUP BY 1""",
            "fact",
        ),
    ),
    "metric_age_at_first_condition": Query(
        lambda m: metrics.metric_age_at_first_condition(m.fact_chronic, m.dim_patient),
        sql(
            """SELECT person_id, year(min(condition_start_date)::DATE) - any_value(year_of_birth)
                          AS age_at_first_condition
               FROM fact JOIN person USING (person_id) WHERE is_chronic GROUP BY 1""",
            "fact",
        ),
    ),
    "calculate_metric": Query(
        lambda m: metrics.calculate_metric(
            _SPEC, {"fact_chronic_condition": m.fact_chronic}, ["condition_name"], "month"
        ),
        sql(
            """SELECT condition_name,
                      date_trunc('month', condition_start_date::DATE)::DATE AS date_month,
                      count(condition_concept_id) AS chronic_condition_count
               FROM fact WHERE is_chronic GROUP BY 1, 2""",
            "fact",
        ),
    ),
    "calculate_metric_distinct": Query(
        lambda m: metrics.calculate_metric(
            _PATIENT_SPEC, {"fact_chronic_condition": m.fact_chronic}, ["condition_name"]
        ),
        sql(
            """SELECT condition_name, count(DISTINCT person_id) AS patients
               FROM fact GROUP BY 1""",
            "fact",
        ),
    ),
    "calculate_metric_incremental": Query(
        lambda m: _incremental(m, _SPEC, ["condition_name"], "month"),
        sql(
            """SELECT condition_name,
                      date_trunc('month', condition_start_date::DATE)::DATE AS date_month,
                      count(condition_concept_id) AS chronic_condition_count
               FROM fact WHERE is_chronic GROUP BY 1, 2""",
            "fact",
        ),
    ),
    "calculate_metric_distinct_incremental": Query(
        lambda m: _incremental(m, _DATED_PATIENT_SPEC, ["condition_name"]),
        sql(
            """SELECT condition_name, count(DISTINCT person_id) AS patients
               FROM fact GROUP BY 1""",
            "fact",
        ),
    ),
    "hash_tree": Query(
        hash_tree,
        sql(
            f"""SELECT key_range, count(*) AS row_count, sum(part)::VARCHAR AS content_hash
                FROM (SELECT unnest(['', leaf[:1], leaf]) AS key_range, part
                      FROM (SELECT substr(md5(len(measurement_id) || ':' || measurement_id), 1, 2) AS leaf,
                                   ('0x' || substr({_MEASURED_MD5}, 1, 13))::BIGINT AS part
                            FROM meas))
                GROUP BY 1""",
            "meas",
        ),
    ),
    "changed_rows": Query(
        changed_rows,
        sql(
            """SELECT measurement_id, person_id, value_as_number + 1 AS value_as_number,
                      measurement_date
               FROM meas WHERE person_id % 97 = 0""",
            "meas",
        ),
    ),
    "resource_counts_by_type": Query(
        lambda m: bundles.resource_counts_by_type(
            m.raw("patients")
            .select("record_content")
            .unionByName(m.raw("encounters").select("record_content"))
            .unionByName(m.raw("observations").select("record_content"))
        ),
        """SELECT 'Patient' AS resource_type, count(*) AS resource_count FROM customer
           UNION ALL SELECT 'Encounter', count(*) FROM orders
           UNION ALL SELECT 'Observation', count(*) FROM lineitem""",
    ),
    "dataset_hash": Query(
        lambda m: metrics.dataset_hash(
            m.measurement, ["measurement_id", "person_id", "value_as_number", "measurement_date"]
        ),
        sql(
            """SELECT count(*) AS row_count,
                      sum(('0x' || substr(md5(list_aggregate(list_transform(
                              [measurement_id::VARCHAR, person_id::VARCHAR, value_as_number::VARCHAR,
                               measurement_date::VARCHAR], lambda c: len(c) || ':' || c),
                          'string_agg', '')), 1, 13))::BIGINT)::VARCHAR AS content_hash
               FROM meas""",
            "meas",
        ),
    ),
    "pct_of_total": Query(
        lambda m: metrics.pct_of_total(_counted(m), "persons", "share", 3),
        sql(
            """SELECT race_concept_id, count(*) AS persons,
                      round(count(*) * 100.0 / sum(count(*)) OVER (), 3) AS share
               FROM person GROUP BY 1""",
            "person",
        ),
    ),
    "top_20": Query(
        lambda m: metrics.top_20(
            metrics.condition_counts(m.condition, "person_id"), "condition_count", "person_id"
        ),
        sql(
            """SELECT person_id, count(*) AS condition_count FROM cond GROUP BY 1
               ORDER BY 2 DESC, 1 LIMIT 20""",
            "cond",
        ),
    ),
    "order_asc": Query(
        lambda m: metrics.order_asc(
            m.person.groupBy("year_of_birth").agg(F.count(F.lit(1)).alias("persons")),
            "year_of_birth",
        ),
        sql(
            "SELECT year_of_birth, count(*) AS persons FROM person GROUP BY 1 ORDER BY 1", "person"
        ),
    ),
    "set_difference": Query(
        lambda m: sets.set_difference(
            m.person_defects,
            m.flat_patient_defects.select(F.col("person_id_omop").alias("person_id")),
            ["person_id"],
        ),
        sql(
            """SELECT person_id FROM person_d EXCEPT
               SELECT person_id_omop FROM flat_d""",
            "person_d",
            "flat_d",
        ),
    ),
    "disjoint_ids": Query(
        lambda m: sets.disjoint_ids(
            m.tenant_raw("patients")
            .filter("organization_id = 'org-1'")
            .select(F.try_variant_get("record_content", "$.id", "string").alias("id")),
            m.tenant_raw("patients")
            .filter("organization_id = 'org-2'")
            .select(F.try_variant_get("record_content", "$.id", "string").alias("id")),
            "id",
        ),
        sql(
            """SELECT count(*) AS shared_ids, count(*) = 0 AS disjoint
               FROM (SELECT patient_id FROM pat WHERE organization_id = 'org-1' INTERSECT
                     SELECT patient_id FROM pat WHERE organization_id = 'org-2')""",
            "pat",
        ),
    ),
    "distinct": Query(
        lambda m: sets.distinct_values(m.stg_encounter, ["status", "class_code"]),
        sql("SELECT DISTINCT status, class_code FROM enc", "enc"),
    ),
}
