"""Wide rows of the observations are shuffled once, whatever their keys are."""

import re

from medloom.operators import marts, staging
from medloom.plans.clinical import Clinical
from tests.test_colocated import no_broadcast  # noqa: F401

SF = "/root/testdata/sf0.001"


def test_observations_are_shuffled_once(spark, no_broadcast):  # noqa: F811
    spark.conf.set("spark.sql.debug.maxToStringFields", "500")
    plan = Clinical(spark, SF).api_observation._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    below = re.split(r"Exchange hashpartitioning", plan)[1:]
    # The part of the plan right below an exchange, up to the next one.
    wide = [part for part in below if "performer_display" in part.split("\n")[1]]
    assert len(wide) == 1
    # Derived columns come after the shuffle.
    assert "is_abnormal" not in wide[0]


def test_null_missing_and_repeated_keys(spark, docs):
    def observation(id_, patient, encounter):
        subject = f',"subject":{{"reference":"Patient/{patient}"}}' if patient is not None else ""
        visit = f',"encounter":{{"reference":"Encounter/{encounter}"}}' if encounter is not None else ""
        return f'{{"resourceType":"Observation","id":"{id_}"{subject}{visit}}}'

    keys = [(p, e) for p in ("1", "2", "9", "", None) for e in ("1", "2", "9", "", None)]
    observations = docs(*[observation(f"o{i % 23}", p, e) for i, (p, e) in enumerate(keys)], "{}")
    patient = '{"id":%s,"name":[{"family":"%s","given":["A"]}]}'
    patients = docs(patient % ('"1"', "one"), patient % ('"2"', "two"), patient % ('"2"', "too"), patient % ('""', "none"))
    encounter = '{"id":%s,"class":{"display":"%s"}}'
    encounters = docs(*[encounter % x for x in (('"1"', "a"), ('"2"', "b"), ('"2"', "c"), ('""', "d"), ("null", "e"))])
    staged = (
        staging.stg_observation(observations),
        marts.api_patient(staging.stg_patient(patients), "2025-01-01"),
        staging.stg_encounter(encounters),
    )
    once, direct = (marts.api_observation(*staged, colocated=c) for c in (False, True))
    assert once.schema == direct.schema
    assert sorted(map(repr, once.collect())) == sorted(map(repr, direct.collect()))
    # One row for every pair of a patient and an encounter that match, or one without.
    patients_of, encounters_of = {"2": 2}, {"2": 2}
    assert once.count() == sum(patients_of.get(p, 1) * encounters_of.get(e, 1) for p, e in keys)
