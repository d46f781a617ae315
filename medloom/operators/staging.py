"""Documents -> flat typed columns, and flat rows -> documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.functions.documents import extension_value, path, ref_id
from medloom.schemas import OMOP_SCHEMAS, PERSON_ID_URL

_SOURCE = ("source_file", "ingestion_time")


def _coding(expr: str, prefix: str, *parts: str) -> list[Column]:
    return [path(f"{expr}.{p}").alias(f"{prefix}_{p}") for p in parts]


def stg_patient(raw: DataFrame) -> DataFrame:
    return raw.select(
        path(".id").alias("patient_id"),
        path(".active", "boolean").alias("active"),
        path(".gender").alias("gender"),
        path(".birthDate", "date").alias("birth_date"),
        path(".deceasedDateTime", "timestamp_ntz").alias("deceased_datetime"),
        path(".name[0].family").alias("name_family"),
        path(".name[0].given[0]").alias("name_given"),
        path(".address[0].city").alias("city"),
        path(".address[0].state").alias("state"),
        path(".address[0].postalCode").alias("postal_code"),
        path(".address[0].country").alias("country"),
        *_SOURCE,
    )


def stg_encounter(raw: DataFrame) -> DataFrame:
    return raw.select(
        path(".id").alias("encounter_id"),
        path(".status").alias("status"),
        *_coding(".class", "class", "code", "display"),
        ref_id(path(".subject.reference")).alias("patient_id"),
        path(".subject.display").alias("patient_display"),
        path(".period.start", "timestamp_ntz").alias("period_start"),
        path(".period.end", "timestamp_ntz").alias("period_end"),
        *_coding(".type[0].coding[0]", "type", "code", "display", "system"),
        ref_id(path(".serviceProvider.reference")).alias("service_provider_id"),
        path(".serviceProvider.display").alias("service_provider_display"),
        *_coding(".reasonCode[0].coding[0]", "reason", "code", "display"),
        ref_id(path(".participant[0].individual.reference")).alias("participant_id"),
        path(".participant[0].individual.display").alias("participant_display"),
        ref_id(path(".location[0].location.reference")).alias("location_id"),
        path(".location[0].location.display").alias("location_display"),
        *_SOURCE,
    )


def stg_observation(raw: DataFrame) -> DataFrame:
    low, high = ".referenceRange[0].low", ".referenceRange[0].high"
    return raw.select(
        path(".id").alias("observation_id"),
        path(".status").alias("status"),
        *_coding(".category[0].coding[0]", "category", "code", "display", "system"),
        path(".code.coding[0].code").alias("code"),
        *_coding(".code.coding[0]", "code", "display", "system"),
        ref_id(path(".subject.reference")).alias("patient_id"),
        path(".subject.display").alias("patient_display"),
        ref_id(path(".encounter.reference")).alias("encounter_id"),
        path(".effectiveDateTime", "timestamp_ntz").alias("effective_datetime"),
        path(".effectivePeriod.start", "timestamp_ntz").alias("effective_period_start"),
        path(".effectivePeriod.end", "timestamp_ntz").alias("effective_period_end"),
        path(".issued", "timestamp_ntz").alias("issued"),
        path(".valueQuantity.value", "double").alias("value_quantity"),
        *_coding(".valueQuantity", "value", "unit", "system", "code"),
        path(".valueString").alias("value_string"),
        path(".valueBoolean", "boolean").alias("value_boolean"),
        *_coding(".valueCodeableConcept.coding[0]", "value_codeable", "code", "display"),
        path(f"{low}.value", "double").alias("reference_range_low"),
        path(f"{high}.value", "double").alias("reference_range_high"),
        path(f"{low}.unit").alias("reference_range_unit"),
        *_coding(".interpretation[0].coding[0]", "interpretation", "code", "display"),
        ref_id(path(".performer[0].reference")).alias("performer_id"),
        path(".performer[0].display").alias("performer_display"),
        *_SOURCE,
    )


def flatten_patient(
    raw: DataFrame, ingested_at: Column, person_id_url: str = PERSON_ID_URL
) -> DataFrame:
    """Flat patient with defaults; dates stay text. ``ingested_at`` is ISO text."""
    active = path(".active", "variant")
    return raw.select(
        path(".id").alias("patient_id"),
        extension_value(person_id_url).alias("person_id_omop"),
        F.when(active.isNull(), True).otherwise(path(".active", "boolean")).alias("active"),
        path(".name[0].family").alias("family_name"),
        path(".name[0].given[0]").alias("given_name"),
        path(".birthDate").alias("birth_date"),
        path(".gender").alias("gender"),
        path(".deceasedDateTime").alias("deceased_datetime"),
        path(".communication[0].language.coding[0].code").alias("language"),
        path(".address[0].country").alias("country"),
        path(".address[0].postalCode").alias("postal_code"),
        path(".address[0].city").alias("city"),
        path(".address[0].state").alias("state"),
        F.when(path(".meta.source", "variant").isNull(), "unknown")
        .otherwise(path(".meta.source"))
        .alias("synthetic_source"),
        ingested_at.alias("ingestion_timestamp"),
        ingested_at.alias("fhir_ingestion_ts"),
    )


_IDENTIFIERS = (
    "array<struct<system:string,value:string,type:struct<coding:array<struct<code:string>>>>>"
)
_NAMES = "array<struct<use:string,family:string,given:array<string>>>"


def patient_identifiers(raw: DataFrame) -> DataFrame:
    """Record number, social security number, other ids, official (else first) name.

    The last matching identifier wins, as each match replaces the one before.
    """
    ids = path(".identifier", _IDENTIFIERS)

    def is_mrn(i: Column) -> Column:
        code = F.get(i["type"]["coding"], F.lit(0))["code"]
        return F.coalesce(code.contains("MR"), F.lit(False))

    def is_ssn(i: Column) -> Column:
        return F.coalesce(i["system"].contains("SSN"), F.lit(False))

    def last_value(keep) -> Column:
        kept = F.filter(ids, keep)
        last = F.try_element_at(kept, F.lit(-1))
        return F.when(F.size(kept) > 0, F.coalesce(last["value"], F.lit("")))

    others = F.transform(
        F.filter(ids, lambda i: ~is_mrn(i) & ~is_ssn(i)),
        lambda i: F.struct(
            F.coalesce(i["system"], F.lit("")).alias("system"),
            F.coalesce(i["value"], F.lit("")).alias("value"),
        ),
    )
    names = path(".name", _NAMES)
    official = F.filter(names, lambda n: n["use"] == "official")
    name = F.coalesce(F.get(official, F.lit(0)), F.get(names, F.lit(0)))
    named = F.size(names) > 0
    return raw.select(
        path(".id").alias("patient_id"),
        last_value(is_mrn).alias("mrn"),
        last_value(lambda i: ~is_mrn(i) & is_ssn(i)).alias("ssn"),
        F.when(F.size(others) > 0, others).alias("other_ids"),
        F.when(named, F.coalesce(name["family"], F.lit(""))).alias("family_name"),
        F.when(named, F.coalesce(name["given"], F.array().cast("array<string>"))).alias(
            "given_names"
        ),
        path(".birthDate").alias("birth_date"),
        path(".gender").alias("gender"),
    )


def stg_person(person: DataFrame) -> DataFrame:
    return person.select(
        *OMOP_SCHEMAS["person"], F.col("ingestion_timestamp").alias("_ingestion_ts")
    )


def stg_condition_occurrence(condition: DataFrame) -> DataFrame:
    return condition.select(*OMOP_SCHEMAS["condition_occurrence"])


def stg_measurement(measurement: DataFrame) -> DataFrame:
    return measurement.select(*OMOP_SCHEMAS["measurement"])


def _iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


def _present(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(""))


def to_fhir_patient(df: DataFrame) -> DataFrame:
    """``patient_id, gender, birth_date[, updated_at]`` -> Patient JSON in ``value``."""
    parts = [
        F.lit("Patient").alias("resourceType"),
        F.col("patient_id").alias("id"),
        _present("gender").alias("gender"),
        F.date_format("birth_date", "yyyy-MM-dd").alias("birthDate"),
    ]
    if "updated_at" in df.columns:
        stamp = F.col("updated_at")
        parts.append(
            F.when(stamp.isNotNull(), F.struct(_iso(stamp).alias("lastUpdated"))).alias("meta")
        )
    return df.select(F.col("patient_id").alias("id"), F.to_json(F.struct(*parts)).alias("value"))


def _subject() -> Column:
    reference = F.concat(F.lit("Patient/"), _present("patient_id"))
    return F.when(reference.isNotNull(), F.struct(reference.alias("reference"))).alias("subject")


def to_fhir_encounter(df: DataFrame) -> DataFrame:
    """``encounter_id, status, patient_id, period_start, period_end`` -> Encounter JSON."""
    start, end = F.col("period_start"), F.col("period_end")
    period = F.struct(_iso(start).alias("start"), _iso(end).alias("end"))
    body = F.struct(
        F.lit("Encounter").alias("resourceType"),
        F.col("encounter_id").alias("id"),
        F.coalesce("status", F.lit("unknown")).alias("status"),
        _subject(),
        F.when(start.isNotNull() | end.isNotNull(), period).alias("period"),
    )
    return df.select(F.col("encounter_id").alias("id"), F.to_json(body).alias("value"))


def to_fhir_observation(df: DataFrame) -> DataFrame:
    """``observation_id, status, code, code_display, patient_id, value_quantity, value_unit``."""
    coding = F.struct(
        F.lit("http://loinc.org").alias("system"),
        F.col("code").alias("code"),
        F.col("code_display").alias("display"),
    )
    value = F.struct(F.col("value_quantity").alias("value"), F.col("value_unit").alias("unit"))
    body = F.struct(
        F.lit("Observation").alias("resourceType"),
        F.col("observation_id").alias("id"),
        F.coalesce("status", F.lit("final")).alias("status"),
        F.when(_present("code").isNotNull(), F.struct(F.array(coding).alias("coding"))).alias(
            "code"
        ),
        _subject(),
        F.when(F.col("value_quantity").isNotNull(), value).alias("valueQuantity"),
    )
    return df.select(F.col("observation_id").alias("id"), F.to_json(body).alias("value"))
