"""Denormalised marts and dimensional models."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.functions.clinical import (
    age_years,
    encounter_duration_hours,
    encounter_is_active,
    observation_category_type,
    observation_is_abnormal,
    observation_value_display,
)
from medloom.functions.concepts import named
from medloom.operators.lineage import lineage_columns
from medloom.schemas import (
    API_ENCOUNTER_CONTRACT,
    API_OBSERVATION_CONTRACT,
    API_PATIENT_CONTRACT,
    CONDITION_NAMES,
    CORE_DIAGNOSIS_CONCEPTS,
)


def api_patient(stg_patient: DataFrame, as_of: str) -> DataFrame:
    enriched = stg_patient.filter(F.col("patient_id").isNotNull()).withColumns(
        {
            "full_name": F.concat("name_given", F.lit(" "), "name_family"),
            "age": age_years(F.col("birth_date"), F.col("deceased_datetime"), as_of),
            "is_deceased": F.col("deceased_datetime").isNotNull(),
            "ingestion_time": F.col("ingestion_time").cast("timestamp_ntz"),
        }
    )
    return enriched.select(*API_PATIENT_CONTRACT)


def api_encounter(stg_encounter: DataFrame, api_patient: DataFrame) -> DataFrame:
    patients = api_patient.select(
        "patient_id",
        F.col("full_name").alias("patient_name"),
        F.col("gender").alias("patient_gender"),
    )
    encounters = stg_encounter.filter(F.col("encounter_id").isNotNull())
    enriched = encounters.join(patients, "patient_id", "left").withColumns(
        {
            "duration_hours": encounter_duration_hours(F.col("period_start"), F.col("period_end")),
            "is_active": encounter_is_active(F.col("status")),
            "ingestion_time": F.col("ingestion_time").cast("timestamp_ntz"),
        }
    )
    return enriched.select(*API_ENCOUNTER_CONTRACT)


def _null_safe(column: str) -> Column:
    """A text for a key, another one for a null: equal exactly when the keys are the same."""
    return F.coalesce(F.concat(F.lit("="), column), F.lit(""))


def _joined_once(observations: DataFrame, encounters: DataFrame, patients: DataFrame) -> DataFrame:
    """Both joins of the observations in one: the pairs of keys that they name are joined first, so
    their wide rows are shuffled once."""
    keys = {"encounter_id": "named_encounter", "patient_id": "named_patient"}
    named = observations.select(*[F.col(c).alias(n) for c, n in keys.items()]).distinct()
    pairs = named.select(*[F.col(n).alias(c) for c, n in keys.items()])
    links = pairs.join(encounters, "encounter_id", "left").join(patients, "patient_id", "left")
    safe = {f"_{c}": _null_safe(c) for c in keys}
    keyed = links.withColumns(safe).select(*safe, "encounter_class", "patient_name")
    return observations.withColumns(safe).join(keyed, list(safe), "left")


def api_observation(
    stg_observation: DataFrame,
    api_patient: DataFrame,
    stg_encounter: DataFrame,
    colocated: bool = False,
) -> DataFrame:
    """The wide rows of the observations are shuffled once.

    ``colocated`` joins the encounters directly and first: tables bucketed by their id
    (``write_bucketed``) meet without a shuffle of the observations.
    """
    patients = api_patient.select("patient_id", F.col("full_name").alias("patient_name"))
    encounters = stg_encounter.select(
        "encounter_id", F.col("class_display").alias("encounter_class")
    )
    observations = stg_observation.filter(F.col("observation_id").isNotNull())
    if colocated:
        joined = observations.join(encounters, "encounter_id", "left").join(patients, "patient_id", "left")
    else:
        joined = _joined_once(observations, encounters, patients)
    # What follows from other columns is not shuffled.
    enriched = joined.withColumns(
        {
            "value_display": observation_value_display(
                F.col("value_quantity"),
                F.col("value_unit"),
                F.col("value_string"),
                F.col("value_boolean"),
                F.col("value_codeable_display"),
            ),
            "is_abnormal": observation_is_abnormal(
                F.col("interpretation_code"),
                F.col("value_quantity"),
                F.col("reference_range_low"),
                F.col("reference_range_high"),
            ),
            "category_type": observation_category_type(F.col("category_code")),
            "ingestion_time": F.col("ingestion_time").cast("timestamp_ntz"),
        }
    )
    return enriched.select(*API_OBSERVATION_CONTRACT)


def patient_conditions_risk(person: DataFrame, condition: DataFrame) -> DataFrame:
    """Per person: distinct conditions, three flags and a risk class.

    Conditions are reduced to one row per person before the join, so a person with very
    many records costs the join nothing.
    """
    flags = {"has_diabetes": 201826, "has_hypertension": 320128, "has_asthma": 317009}
    # Duplicates go first (spread over person and concept): no per-person distinct set.
    distinct = condition.select("person_id", "condition_concept_id").distinct()
    per_person = distinct.groupBy("person_id").agg(
        F.count("condition_concept_id").alias("condition_count"),
        *[
            F.max(F.when(F.col("condition_concept_id") == c, 1).otherwise(0)).alias(n)
            for n, c in flags.items()
        ],
    )
    hits = sum((F.col(n) for n in flags), F.lit(0))
    return (
        person.select("person_id", "year_of_birth", "gender_concept_id")
        .join(per_person, "person_id", "left")
        .fillna(0, ["condition_count", *flags])
        .withColumn(
            "risk_category",
            F.when(hits >= 2, "High Risk").when(hits == 1, "Moderate Risk").otherwise("Low Risk"),
        )
    )


def dim_condition(
    condition: DataFrame, names: Mapping[int, str] = CONDITION_NAMES
) -> DataFrame:
    concepts = condition.select("condition_concept_id").distinct()
    return concepts.withColumn("condition_name", named("condition_concept_id", names))


def dim_patient(
    flat_patient: DataFrame, person: DataFrame, ingestion_ts: Column | None = None, **lineage: str
) -> DataFrame:
    """One row per person, with the FHIR side where it exists.

    With an ``ingestion_ts`` the lineage columns are added; the origin names the sides a row has,
    ``lineage`` goes to ``lineage_columns``.
    """
    gender = (
        F.when(F.col("gender_concept_id") == 8507, "male")
        .when(F.col("gender_concept_id") == 8532, "female")
        .otherwise("unknown")
    )
    fhir = (
        flat_patient.filter(F.col("person_id_omop").isNotNull())
        .groupBy(F.col("person_id_omop").alias("person_id"))
        .agg(
            F.min_by(
                F.struct("patient_id", "birth_date", "deceased_datetime", "city", "state"),
                "patient_id",
            ).alias("f")
        )
    )
    rows = person.join(fhir, "person_id", "left").select(
        "person_id",
        F.col("f.patient_id").alias("patient_id"),
        gender.alias("gender"),
        "year_of_birth",
        F.col("f.birth_date").try_cast("date").alias("birth_date"),
        F.when(F.col("f.patient_id").isNotNull(), F.col("f.deceased_datetime").isNotNull()).alias(
            "is_deceased"
        ),
        F.col("f.city").alias("city"),
        F.col("f.state").alias("state"),
    )
    if ingestion_ts is None:
        return rows
    origin = F.when(F.col("patient_id").isNull(), "omop").otherwise("omop+fhir")
    return lineage_columns(rows, ingestion_ts, origin, model="dim_patient", **lineage)


def fact_chronic_condition(
    condition: DataFrame,
    patients: DataFrame,
    concept_set: Collection[int] = CORE_DIAGNOSIS_CONCEPTS,
    names: Mapping[int, str] = CONDITION_NAMES,
) -> DataFrame:
    """Condition records of known persons, with ``is_chronic`` and a name.

    ``patients`` is the patient dimension or any frame with its ``person_id``, one row each.
    """
    concept = F.col("condition_concept_id")
    return condition.join(patients.select("person_id"), "person_id").select(
        "condition_occurrence_id",
        "person_id",
        "condition_concept_id",
        named("condition_concept_id", names).alias("condition_name"),
        "condition_start_date",
        "condition_start_datetime",
        concept.isin(*concept_set).alias("is_chronic"),
    )
