"""Raw tables -> staging -> marts as one lazy plan per input folder."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.functions.documents import path, ref_id
from medloom.operators import marts, staging
from medloom.plans import fixtures
from medloom.plans.landing import bucketed_table, buckets_for, lookup_table, raw_table


@dataclass(frozen=True)
class Clinical:
    """All models over one input folder; every attribute is lazy."""

    spark: SparkSession
    sf_dir: str
    as_of: str = fixtures.AS_OF

    def raw(self, name: str) -> DataFrame:
        return raw_table(self.spark, self.sf_dir, name)

    def find(self, name: str, params: Mapping[str, str], exact_patient: bool = False) -> DataFrame:
        """The raw documents of the files that can match a look-up or search."""
        return lookup_table(self.spark, self.sf_dir, name).pruned(params, exact_patient)

    @cached_property
    def stg_patient(self) -> DataFrame:
        return staging.stg_patient(self.raw("patients"))

    @cached_property
    def stg_encounter(self) -> DataFrame:
        return staging.stg_encounter(self.raw("encounters"))

    @cached_property
    def stg_observation(self) -> DataFrame:
        return staging.stg_observation(self.raw("observations"))

    @cached_property
    def api_patient(self) -> DataFrame:
        return marts.api_patient(self.stg_patient, self.as_of)

    @cached_property
    def api_encounter(self) -> DataFrame:
        return marts.api_encounter(self.stg_encounter, self.api_patient)

    @cached_property
    def api_observation(self) -> DataFrame:
        return marts.api_observation(self.stg_observation, self.api_patient, self.stg_encounter)

    @cached_property
    def api_observation_colocated(self) -> DataFrame:
        """The observation mart from tables in buckets of the encounter id."""
        staged = {"observations": self.stg_observation, "encounters": self.stg_encounter}
        buckets = buckets_for(*staged.values())
        observations, encounters = (
            bucketed_table(self.spark, self.sf_dir, name, df, "encounter_id", buckets) for name, df in staged.items()
        )
        return marts.api_observation(observations, self.api_patient, encounters, colocated=True)

    @cached_property
    def flat_patient(self) -> DataFrame:
        return staging.flatten_patient(self.raw("patients"), F.lit(fixtures.INGESTED_AT))

    @cached_property
    def person(self) -> DataFrame:
        return fixtures.person(self.spark, self.sf_dir)

    @cached_property
    def condition(self) -> DataFrame:
        return fixtures.condition_occurrence(self.spark, self.sf_dir)

    @cached_property
    def measurement(self) -> DataFrame:
        return fixtures.measurement(self.spark, self.sf_dir)

    @cached_property
    def dim_patient(self) -> DataFrame:
        ingested = F.lit(self.as_of).cast("timestamp_ntz")
        return marts.dim_patient(self.flat_patient, self.person, ingested, pipeline_run_id="run-1")

    @cached_property
    def fact_chronic(self) -> DataFrame:
        # Only the ids of the dimension are needed: one per person.
        return marts.fact_chronic_condition(self.condition, self.person)

    # Documents with their tenant.

    def tenant_raw(self, name: str) -> DataFrame:
        tenant = {
            "patients": ref_id(path(".managingOrganization.reference")),
            "encounters": ref_id(path(".serviceProvider.reference")),
            "observations": path(".meta.tag[0].code"),
        }[name]
        return self.raw(name).withColumn("organization_id", tenant)

    # Copies with injected defects (FIXTURES.md, part B): all rows stay, some keys or dates move.

    @cached_property
    def flat_patient_defects(self) -> DataFrame:
        key = F.col("person_id_omop")
        moved = F.date_add(F.col("birth_date").cast("date"), 1).cast("string")
        return self.flat_patient.withColumns(
            {
                "birth_date": F.when(key % 53 == 0, moved).otherwise(F.col("birth_date")),
                "person_id_omop": F.when(key % 97 == 0, -key - 1).otherwise(key),
            }
        )

    @cached_property
    def person_defects(self) -> DataFrame:
        key = F.col("person_id")
        return self.person.withColumn(
            "person_id", F.when(key % 89 == 0, key + 1_000_000_000_000).otherwise(key)
        )

    @cached_property
    def stg_patient_defects(self) -> DataFrame:
        return self.stg_patient.withColumn("patient_id", _moved("patient_id", 97))

    @cached_property
    def stg_encounter_defects(self) -> DataFrame:
        return self.stg_encounter.withColumn("encounter_id", _moved("encounter_id", 101))


def _moved(column: str, every: int) -> Column:
    id_ = F.col(column)
    return F.when(id_.cast("bigint") % every == 0, F.concat(F.lit("moved-"), id_)).otherwise(id_)
