"""Tables in buckets of a key meet without a shuffle."""

import re

import pytest

from medloom.plans.clinical import Clinical

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((\w+)#", plan)


def test_observations_and_encounters_meet_in_place(spark, no_broadcast):
    m = Clinical(spark, SF)
    assert shuffles(m.api_observation).count("encounter_id") == 2
    colocated = shuffles(m.api_observation_colocated)
    # The patients still come by a shuffle, the encounters do not.
    assert "encounter_id" not in colocated and "patient_id" in colocated
    assert m.api_observation_colocated.count() == m.api_observation.count()
