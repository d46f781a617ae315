"""Fixed schemas, contracts and code lists."""

from __future__ import annotations

# OMOP table columns and types.
OMOP_SCHEMAS: dict[str, dict[str, str]] = {
    "person": {
        "person_id": "bigint",
        "gender_concept_id": "bigint",
        "year_of_birth": "bigint",
        "month_of_birth": "bigint",
        "day_of_birth": "bigint",
        "birth_datetime": "string",
        "race_concept_id": "bigint",
        "ethnicity_concept_id": "bigint",
        "person_source_value": "string",
        "gender_source_value": "string",
        "race_source_value": "string",
        "ethnicity_source_value": "string",
    },
    "condition_occurrence": {
        "condition_occurrence_id": "string",
        "person_id": "bigint",
        "condition_concept_id": "bigint",
        "condition_start_date": "string",
        "condition_start_datetime": "string",
        "condition_type_concept_id": "bigint",
        "visit_occurrence_id": "bigint",
    },
    "measurement": {
        "measurement_id": "string",
        "person_id": "bigint",
        "measurement_concept_id": "bigint",
        "measurement_date": "string",
        "measurement_datetime": "string",
        "measurement_type_concept_id": "bigint",
        "value_as_number": "double",
        "unit_concept_id": "bigint",
        "visit_occurrence_id": "bigint",
    },
}

# Partition column per OMOP table; events are laid out by their day.
OMOP_PARTITIONS = {
    "person": "year_of_birth",
    "condition_occurrence": "condition_start_date",
    "measurement": "measurement_date",
}

# Concept ids and names.
GENDER_CONCEPTS = {8507: "Male", 8532: "Female"}
CONDITION_NAMES = {
    201826: "Type 2 Diabetes",
    320128: "Essential Hypertension",
    317009: "Asthma",
}
MEASUREMENT_NAMES = {
    3004501: "Glucose (mg/dL)",
    3012888: "Systolic BP (mmHg)",
    3038553: "BMI (kg/m²)",
}
CORE_DIAGNOSIS_CONCEPTS = (201826, 320128, 201254)

# FHIR code lists.
GENDER_CODES = ("male", "female", "other", "unknown")
ACTIVE_ENCOUNTER_STATUS = ("in-progress", "arrived", "triaged", "onleave")
ABNORMAL_INTERPRETATIONS = ("H", "HH", "L", "LL", "A", "AA")
OBSERVATION_CATEGORIES = (
    "vital-signs",
    "laboratory",
    "imaging",
    "procedure",
    "survey",
    "exam",
    "therapy",
    "activity",
)
BUNDLE_TYPES = ("transaction", "batch", "collection", "message", "document")
UPLOAD_EXTENSIONS = {
    "application/fhir+json": ".json",
    "application/json": ".json",
    "application/fhir+ndjson": ".ndjson",
    "application/x-ndjson": ".ndjson",
}

# Extension that carries the OMOP person id inside a Patient; senders use their own url.
PERSON_ID_URL = "urn:omop:person-id"

# Domain constraint and distribution profile defaults.
DOMAIN_CONSTRAINTS = {
    "patient": [
        {
            "id": "patient_age_range",
            "type": "range",
            "model": "omop.person",
            "field": "year_of_birth",
            "min": 1920,
            "max": 2020,
        }
    ]
}
AGE_PROFILE = {"mean": 50.0, "stddev": 15.0, "min": 0.0, "max": 100.0}

# Contracts of the mart tables, name -> (type, constraints).
API_PATIENT_CONTRACT = {
    "patient_id": ("string", ("not_null", "unique")),
    "active": ("boolean", ()),
    "gender": ("string", ()),
    "birth_date": ("date", ()),
    "deceased_datetime": ("timestamp_ntz", ()),
    "name_family": ("string", ()),
    "name_given": ("string", ()),
    "city": ("string", ()),
    "state": ("string", ()),
    "postal_code": ("string", ()),
    "country": ("string", ()),
    "source_file": ("string", ()),
    "ingestion_time": ("timestamp_ntz", ()),
    "full_name": ("string", ()),
    "age": ("bigint", ()),
    "is_deceased": ("boolean", ()),
}
API_ENCOUNTER_CONTRACT = {
    "encounter_id": ("string", ("not_null", "unique")),
    "status": ("string", ()),
    "class_code": ("string", ()),
    "class_display": ("string", ()),
    "patient_id": ("string", ("not_null",)),
    "patient_name": ("string", ()),
    "patient_gender": ("string", ()),
    "period_start": ("timestamp_ntz", ()),
    "period_end": ("timestamp_ntz", ()),
    "type_code": ("string", ()),
    "type_display": ("string", ()),
    "type_system": ("string", ()),
    "service_provider_id": ("string", ()),
    "service_provider_display": ("string", ()),
    "reason_code": ("string", ()),
    "reason_display": ("string", ()),
    "participant_id": ("string", ()),
    "participant_display": ("string", ()),
    "location_id": ("string", ()),
    "location_display": ("string", ()),
    "source_file": ("string", ()),
    "ingestion_time": ("timestamp_ntz", ()),
    "duration_hours": ("bigint", ()),
    "is_active": ("boolean", ()),
}
API_OBSERVATION_CONTRACT = {
    "observation_id": ("string", ("not_null", "unique")),
    "status": ("string", ()),
    "category_code": ("string", ()),
    "category_display": ("string", ()),
    "code": ("string", ()),
    "code_display": ("string", ()),
    "code_system": ("string", ()),
    "patient_id": ("string", ("not_null",)),
    "patient_name": ("string", ()),
    "encounter_id": ("string", ()),
    "encounter_class": ("string", ()),
    "effective_datetime": ("timestamp_ntz", ()),
    "effective_period_start": ("timestamp_ntz", ()),
    "effective_period_end": ("timestamp_ntz", ()),
    "issued": ("timestamp_ntz", ()),
    "value_quantity": ("double", ()),
    "value_unit": ("string", ()),
    "value_string": ("string", ()),
    "value_boolean": ("boolean", ()),
    "value_codeable_code": ("string", ()),
    "value_codeable_display": ("string", ()),
    "reference_range_low": ("double", ()),
    "reference_range_high": ("double", ()),
    "reference_range_unit": ("string", ()),
    "interpretation_code": ("string", ()),
    "interpretation_display": ("string", ()),
    "performer_id": ("string", ()),
    "performer_display": ("string", ()),
    "source_file": ("string", ()),
    "ingestion_time": ("timestamp_ntz", ()),
    "value_display": ("string", ()),
    "is_abnormal": ("boolean", ()),
    "category_type": ("string", ()),
}
CONTRACTS = {
    "api_patient": API_PATIENT_CONTRACT,
    "api_encounter": API_ENCOUNTER_CONTRACT,
    "api_observation": API_OBSERVATION_CONTRACT,
}
