"""A third of all rows on one key: split at run time, complete and right."""

import pytest
from pyspark.sql import functions as F

from medloom.operators import joins, marts, metrics

N = 60_000


@pytest.fixture
def small_limits(spark):
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _hot(i, every):
    """One key for every third row."""
    return F.when(F.col(i) % 3 == 0, "hot").otherwise((F.col(i) % every).cast("string"))


def _final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_mart_with_a_hot_patient(spark, small_limits):
    ids = spark.range(N).repartition(8)
    encounters = ids.select(
        F.col("id").cast("string").alias("encounter_id"),
        _hot("id", 997).alias("patient_id"),
        F.lit("finished").alias("status"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("period_start"),
        F.lit("2024-01-02").cast("timestamp_ntz").alias("period_end"),
        F.lit("2024-01-02").cast("timestamp").alias("ingestion_time"),
        *[
            F.sha2(F.concat(F.lit(c), F.col("id").cast("string")), 256).alias(c)
            for c in """class_code class_display type_code type_display type_system
                service_provider_id service_provider_display reason_code reason_display
                participant_id participant_display location_id location_display
                source_file""".split()
        ],
    )
    patients = spark.range(997).select(F.col("id").cast("string").alias("patient_id"))
    patients = patients.union(spark.sql("SELECT 'hot'")).withColumns(
        {"full_name": F.concat(F.lit("n"), "patient_id"), "gender": F.lit("other")}
    )
    mart = marts.api_encounter(encounters, patients)
    rows = mart.select(
        F.count(F.lit(1)), F.countDistinct("encounter_id"),
        F.count_if(F.col("patient_name") == F.concat(F.lit("n"), "patient_id")),
        F.max("location_display"),
    )
    got = rows.first()
    assert (got[0], got[1], got[2]) == (N, N, N)
    mart.write.format("noop").mode("overwrite").save()
    observed = mart.groupBy().agg(F.max(F.struct(*mart.columns)))
    observed.collect()
    assert "skew=true" in _final_plan(observed)


def test_counts_with_a_hot_person(spark):
    condition = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500 + 1).alias("person_id"),
        F.when(F.col("id") % 2 == 0, 201826).otherwise(317009).cast("bigint").alias(
            "condition_concept_id"
        ),
        F.col("id").cast("string").alias("condition_occurrence_id"),
    )
    counts = {r.person_id: r.condition_count for r in joins.condition_count_per_person(condition).collect()}
    assert counts[0] == N // 3 and sum(counts.values()) == N
    person = spark.range(501).select(F.col("id").alias("person_id"))
    rows = metrics.condition_prevalence(condition, person).collect()
    persons = {c: len({0 if i % 3 == 0 else i % 500 + 1 for i in range(N) if (i % 2 == 0) is even})
               for c, even in ((201826, True), (317009, False))}
    assert {r.condition_concept_id: r.patient_count for r in rows} == persons
