import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from medloom.functions import clinical
from medloom.functions.documents import extension_value, ref_id
from medloom.operators import marts, staging

FULL = {
    "resourceType": "Patient",
    "id": "p1",
    "active": False,
    "gender": "female",
    "birthDate": "1980-05-17",
    "deceasedDateTime": "2020-01-02T03:04:05Z",
    "name": [{"use": "official", "family": "Doe", "given": ["Jane", "Q"]}],
    "address": [{"city": "X", "state": "Y", "postalCode": "12345", "country": "US"}],
    "communication": [{"language": {"coding": [{"code": "en"}]}}],
    "meta": {"source": "test"},
    "extension": [
        {"url": "urn:other", "valueInteger": 1},
        {"url": "urn:omop:person-id", "valueInteger": 7},
        {"url": "urn:omop:person-id", "valueInteger": 8},
    ],
}
MINIMAL = {"resourceType": "Patient", "id": "p2", "gender": "male", "birthDate": "1990-01-01"}


def test_stg_patient(docs):
    full, minimal = staging.stg_patient(docs(json.dumps(FULL), json.dumps(MINIMAL))).collect()
    assert full.birth_date == dt.date(1980, 5, 17)
    assert full.deceased_datetime == dt.datetime(2020, 1, 2, 3, 4, 5)
    assert (full.name_family, full.name_given, full.active) == ("Doe", "Jane", False)
    assert minimal.active is None and minimal.city is None and minimal.name_family is None


def test_flatten_patient(docs):
    raw = docs(json.dumps(FULL), json.dumps(MINIMAL))
    full, minimal = staging.flatten_patient(raw, F.lit("t")).collect()
    assert full.person_id_omop == 8  # the last one wins
    assert (full.active, full.language, full.synthetic_source) == (False, "en", "test")
    assert full.birth_date == "1980-05-17"
    assert minimal.active is True and minimal.synthetic_source == "unknown"
    assert minimal.person_id_omop is None and minimal.deceased_datetime is None


def test_extension_without_match(docs):
    assert docs(json.dumps(FULL)).select(extension_value("urn:none")).first()[0] is None


def test_patient_identifiers(docs):
    patient = {
        "id": "1",
        "identifier": [
            {"system": "urn:a", "value": "1", "type": {"coding": [{"code": "MR"}]}},
            {"system": "x/SSN", "value": "2"},
            {"system": "urn:b", "value": "3"},
            {"value": "4"},
            {"system": "x/SSN", "value": "5", "type": {"coding": [{"code": "XMRX"}]}},
        ],
        "name": [{"use": "nickname", "family": "N"}, {"use": "official", "family": "O"}],
    }
    raw = docs(json.dumps(patient), '{"id":"2","name":[{"use":"usual","given":["G"]}]}', '{"id":"3"}')
    one, two, three = staging.patient_identifiers(raw).collect()
    assert (one.mrn, one.ssn, one.family_name, one.given_names) == ("5", "2", "O", [])
    assert [(i.system, i.value) for i in one.other_ids] == [("urn:b", "3"), ("", "4")]
    assert (two.family_name, two.given_names, two.mrn, two.other_ids) == ("", ["G"], None, None)
    assert three.family_name is None and three.given_names is None


@pytest.mark.parametrize("ref, id_", [("Patient/1", "1"), ("a/b/c", "c"), ("x", "x"), (None, None)])
def test_ref_id(spark, ref, id_):
    assert spark.createDataFrame([(ref,)], "r string").select(ref_id(F.col("r"))).first()[0] == id_


def test_bad_cast_is_null(docs):
    row = staging.stg_patient(docs('{"id":1,"birthDate":"no","active":"maybe"}')).first()
    assert (row.patient_id, row.birth_date, row.active) == ("1", None, None)


def _one(spark, column):
    return spark.range(1).select(column).first()[0]


def _ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "start, end, hours",
    [
        ("2024-01-01 00:59:00", "2024-01-01 01:01:00", 1),
        ("2024-01-01 00:00:00", "2024-01-01 00:59:59", 0),
        ("2024-01-02 00:00:00", "2024-01-01 23:59:00", -1),
        (None, "2024-01-01 00:00:00", None),
        ("2024-01-01 00:00:00", None, None),
    ],
)
def test_duration(spark, start, end, hours):
    assert _one(spark, clinical.encounter_duration_hours(_ts(start), _ts(end))) == hours


@pytest.mark.parametrize(
    "birth, dead, age",
    [
        ("2000-12-31", None, 25),
        ("2000-12-31", "2001-01-01 00:00:00", 1),
        (None, None, None),
    ],
)
def test_age(spark, birth, dead, age):
    got = clinical.age_years(F.lit(birth).cast("date"), _ts(dead), "2025-06-01")
    assert _one(spark, got) == age


@pytest.mark.parametrize(
    "quantity, unit, text, flag, code, shown",
    [
        (72.0, None, None, None, None, "72 "),
        (72.5, "mg", "t", True, "c", "72.5 mg"),
        (12345000.0, "u", None, None, None, "12345000 u"),
        (10000000.5, "u", None, None, None, "10000000.5 u"),
        (0.00025, "u", None, None, None, "0.00025 u"),
        (-20000000.0, "u", None, None, None, "-20000000 u"),
        (None, "mg", "t", True, "c", "t"),
        (None, None, None, True, "c", "Yes"),
        (None, None, None, False, "c", "No"),
        (None, None, None, None, "c", "c"),
        (None, None, None, None, None, None),
    ],
)
def test_value_display(spark, quantity, unit, text, flag, code, shown):
    schema = "q double, u string, t string, b boolean, c string"
    df = spark.createDataFrame([(quantity, unit, text, flag, code)], schema)
    columns = [F.col(c) for c in ("q", "u", "t", "b", "c")]
    assert df.select(clinical.observation_value_display(*columns)).first()[0] == shown


@pytest.mark.parametrize(
    "code, quantity, low, high, abnormal",
    [
        ("H", 5.0, 1.0, 9.0, True),
        ("N", 5.0, 1.0, 9.0, False),
        (None, 0.5, 1.0, 9.0, True),
        (None, 9.5, 1.0, 9.0, True),
        (None, 9.5, 1.0, None, False),
        (None, None, 1.0, 9.0, False),
        (None, None, None, None, False),
    ],
)
def test_is_abnormal(spark, code, quantity, low, high, abnormal):
    schema = "i string, q double, l double, h double"
    df = spark.createDataFrame([(code, quantity, low, high)], schema)
    got = df.select(clinical.observation_is_abnormal(*[F.col(c) for c in "iqlh"])).first()[0]
    assert got is abnormal


def test_category_type(spark):
    df = spark.createDataFrame([("laboratory",), ("social",), (None,)], "c string")
    got = [r[0] for r in df.select(clinical.observation_category_type(F.col("c"))).collect()]
    assert got == ["laboratory", "other", "other"]


def test_api_patient_drops_missing_id_and_keeps_null_names(docs):
    raw = docs(json.dumps(FULL), '{"gender":"male"}', '{"id":"x","name":[{"family":"F"}]}')
    rows = marts.api_patient(staging.stg_patient(raw), "2025-01-01").collect()
    assert [(r.patient_id, r.full_name) for r in rows] == [("p1", "Jane Doe"), ("x", None)]
    assert [r.is_deceased for r in rows] == [True, False]


def test_to_fhir_leaves_out_absent_parts(spark):
    schema = (
        "encounter_id string, status string, patient_id string, "
        "period_start timestamp_ntz, period_end timestamp_ntz"
    )
    df = spark.createDataFrame([("e", None, None, None, None)], schema)
    got = json.loads(staging.to_fhir_encounter(df).first().value)
    assert got == {"resourceType": "Encounter", "id": "e", "status": "unknown"}
    schema = (
        "observation_id string, status string, code string, code_display string, "
        "patient_id string, value_quantity double, value_unit string"
    )
    df = spark.createDataFrame([("o", None, None, None, "1", 2.5, None)], schema)
    got = json.loads(staging.to_fhir_observation(df).first().value)
    assert got == {
        "resourceType": "Observation",
        "id": "o",
        "status": "final",
        "subject": {"reference": "Patient/1"},
        "valueQuantity": {"value": 2.5},
    }


def test_risk_keeps_persons_without_conditions(spark):
    person = spark.createDataFrame(
        [(1, 1950, 8507), (2, 1960, 8532), (3, 1970, 0)],
        "person_id bigint, year_of_birth bigint, gender_concept_id bigint",
    )
    condition = spark.createDataFrame(
        [(1, 201826), (1, 201826), (1, 317009), (2, 999)],
        "person_id bigint, condition_concept_id bigint",
    )
    rows = marts.patient_conditions_risk(person, condition).orderBy("person_id").collect()
    assert [(r.condition_count, r.risk_category) for r in rows] == [
        (2, "High Risk"),
        (1, "Low Risk"),
        (0, "Low Risk"),
    ]
