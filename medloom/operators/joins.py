"""Joins between FHIR and OMOP frames, and reference checks.

No join carries a hint: the sizes of both sides decide at run time between a broadcast, a
hash and a sort-merge join, and hot keys are split by the skew rule of adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.operators.metrics import top_n


def fhir_omop_birth_join(person: DataFrame, flat_patient: DataFrame) -> DataFrame:
    """Persons with their FHIR birth date; every matching pair of rows."""
    omop = person.select("person_id", "year_of_birth", "month_of_birth", "day_of_birth")
    fhir = flat_patient.select("person_id_omop", "birth_date")
    return omop.join(fhir, F.col("person_id") == F.col("person_id_omop"))


def distinct_ids(person: DataFrame, flat_patient: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Person ids of the OMOP side and of the FHIR side; unknown ids are left out there."""
    omop = person.select("person_id").distinct()
    fhir = flat_patient.select(F.col("person_id_omop").cast("bigint").alias("person_id"))
    return omop, fhir.filter(F.col("person_id").isNotNull()).distinct()


def missing_in_fhir(person: DataFrame, flat_patient: DataFrame) -> DataFrame:
    omop, fhir = distinct_ids(person, flat_patient)
    return omop.join(fhir, "person_id", "left_anti")


def missing_in_omop(person: DataFrame, flat_patient: DataFrame) -> DataFrame:
    omop, fhir = distinct_ids(person, flat_patient)
    return fhir.join(omop, "person_id", "left_anti")


def condition_count_per_person(condition: DataFrame) -> DataFrame:
    return condition.groupBy("person_id").agg(
        F.count("condition_occurrence_id").alias("condition_count")
    )


def fhir_omop_condition_top(
    stg_patient: DataFrame, person: DataFrame, condition: DataFrame, n: int = 20
) -> DataFrame:
    """Patients of both models with the most condition records."""
    fhir = stg_patient.select(
        F.col("patient_id").alias("fhir_patient_id"),
        F.col("name_family").alias("family_name"),
        F.col("name_given").alias("given_name"),
    )
    omop = person.select("person_id", "year_of_birth")
    counted = (
        omop.join(condition_count_per_person(condition), "person_id", "left")
        .fillna(0, ["condition_count"])
        .withColumn("fhir_patient_id", F.col("person_id").cast("string"))
    )
    keys = ["fhir_patient_id", "family_name", "given_name", "year_of_birth"]
    grouped = (
        fhir.join(counted, "fhir_patient_id")
        .groupBy(*keys)
        .agg(F.sum("condition_count").alias("condition_count"))
    )
    return top_n(grouped, "condition_count", n, "fhir_patient_id")


def person_conditions(person: DataFrame, condition: DataFrame) -> DataFrame:
    """Every person with their condition records; persons without any are kept."""
    return person.select("person_id", "year_of_birth", "gender_concept_id").join(
        condition.select("person_id", "condition_occurrence_id", "condition_concept_id"),
        "person_id",
        "left",
    )


def orphan_records(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Fact rows that point to no dimension row; a null reference is no orphan."""
    keys = dim.select(F.col(pk).alias(fk))
    return fact.filter(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


def cross_org_references(
    facts: DataFrame, patients: DataFrame, org_col: str = "organization_id"
) -> DataFrame:
    """Facts whose patient belongs to another organization."""
    owners = patients.select("patient_id", F.col(org_col).alias("patient_organization_id"))
    return facts.join(owners, "patient_id").filter(
        F.col(org_col) != F.col("patient_organization_id")
    )


def terminology_join(fact: DataFrame, column: str, concept_set: DataFrame) -> DataFrame:
    """Mark rows whose concept is in a concept set (first column of ``concept_set``)."""
    members = concept_set.select(
        F.col(concept_set.columns[0]).alias(column), F.lit(True).alias("in_set")
    ).distinct()
    return fact.join(members, column, "left").fillna(False, ["in_set"])
