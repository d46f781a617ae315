from medloom.functions.clinical import (
    age_years,
    encounter_duration_hours,
    encounter_is_active,
    observation_category_type,
    observation_is_abnormal,
    observation_value_display,
)
from medloom.functions.documents import extension_value, path, ref_id, strict_json, with_default_meta
from medloom.functions.identity import job_date_path, job_id, safe_filename, tokenize

__all__ = [
    "age_years",
    "encounter_duration_hours",
    "encounter_is_active",
    "extension_value",
    "job_date_path",
    "job_id",
    "observation_category_type",
    "observation_is_abnormal",
    "observation_value_display",
    "path",
    "ref_id",
    "safe_filename",
    "strict_json",
    "tokenize",
    "with_default_meta",
]
