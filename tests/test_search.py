import json

import pytest
from pyspark.sql import functions as F

from medloom.operators import search, tenancy


def _observation(i, patient="1", code="2339-0", category="laboratory", when="2024-01-15T10:30:00Z"):
    return json.dumps(
        {
            "resourceType": "Observation",
            "id": str(i),
            "status": "final",
            "category": [{"coding": [{"code": category}]}],
            "code": {"coding": [{"code": code}]},
            "subject": {"reference": f"Patient/{patient}"},
            **({"effectiveDateTime": when} if when else {}),
        }
    )


@pytest.fixture
def observations(docs):
    return docs(
        _observation(1, code="2339-0"),
        _observation(2, code="8867-4", category="vital-signs"),
        _observation(3, code="2339-0", when="2024-01-16T00:00:00Z"),
        _observation(4, patient="12", code="other"),
        _observation(5, patient="2", code="other", when=None),
    )


def _ids(df):
    return [r.id for r in df.select("id").collect()]


def test_newest_first_unknown_before_all(observations):
    assert _ids(search.search_observations(observations, {})) == ["5", "3", "1", "2", "4"]


@pytest.mark.parametrize(
    "params, ids",
    [
        ({"code": "2339-0"}, ["3", "1"]),
        ({"code": "2339-0, 8867-4"}, ["3", "1", "2"]),
        ({"date": "2024-01-15"}, ["1", "2", "4"]),
        ({"date": "2024-01"}, ["3", "1", "2", "4"]),
        ({"patient": "1"}, ["3", "1", "2", "4"]),
        ({"patient": "_2"}, ["4"]),
        ({"patient": "1", "code": "", "status": "final", "_count": "2"}, ["3", "1"]),
        ({"category": "vital-signs"}, ["2"]),
        ({"_count": "2", "_offset": "1"}, ["3", "1"]),
        ({"patient": "a\\b"}, []),
        ({"_count": "0"}, []),
    ],
)
def test_search_observations(observations, params, ids):
    assert _ids(search.search_observations(observations, params)) == ids
    total = search.search_total(observations, "observation", params).first().total
    free = {k: v for k, v in params.items() if not k.startswith("_")}
    assert total == len(_ids(search.search_observations(observations, free)))


def test_exact_patient(observations):
    assert _ids(search.search_observations(observations, {"patient": "1"}, True)) == ["3", "1", "2"]


def test_count_is_capped():
    assert search.Page.of({"_count": "5000"}) == search.Page(1000, 0)
    assert search.Page.of({}) == search.Page(100, 0)


@pytest.mark.parametrize(
    "params", [{"_count": "abc"}, {"_offset": "x"}, {"_count": "-1"}, {"_offset": "-1"}]
)
def test_invalid_paging(params):
    with pytest.raises(search.InvalidSearch):
        search.Page.of(params)


def test_pages_cover_everything_once(docs):
    raw = docs(*[_observation(i) for i in range(25)])
    pages = [
        _ids(search.search_observations(raw, {"_count": "10", "_offset": str(o)}))
        for o in (0, 10, 20)
    ]
    assert [len(p) for p in pages] == [10, 10, 5]
    assert len({i for p in pages for i in p}) == 25


def test_presets(observations):
    assert _ids(search.vital_signs(observations, "1")) == ["2"]
    assert _ids(search.lab_results(observations, "1", count=1, offset=1)) == ["1"]
    assert _ids(search.patient_observations(observations, "2")) == ["5"]


def test_get_by_id(observations):
    assert search.get_by_id(observations, "3").count() == 1
    assert search.get_by_id(observations, "nope").count() == 0


def test_search_bundle(observations):
    bundle = search.search_bundle(observations, "observation", {"code": "2339-0", "_count": "1"})
    body = json.loads(bundle.first().bundle)
    assert body["total"] == 2 and body["type"] == "searchset"
    assert [e["resource"]["id"] for e in body["entry"]] == ["3"]


def test_empty_search_bundle(observations):
    bundle = search.search_bundle(observations, "observation", {"code": "none"})
    body = json.loads(bundle.first().bundle)
    assert body == {"resourceType": "Bundle", "type": "searchset", "total": 0, "entry": []}


def test_search_patients(spark):
    df = spark.sql(
        """SELECT * FROM VALUES ('1', 'M1', 'male', date'1980-01-01', 'Doe John', timestamp_ntz'2024-01-01'),
                                ('2', 'M2', 'female', date'1990-01-01', 'doe jane', timestamp_ntz'2024-01-02')
           AS t(patient_id, external_identifier, gender, birth_date, name_search_index, updated_at)"""
    )

    def ids(**params):
        return [r.patient_id for r in search.search_patients(df, params).collect()]

    assert ids(name="DOE") == ["2", "1"]
    assert ids(gender="MALE") == ["1"]
    assert ids(identifier="M2") == ["2"]
    assert ids(birthdate="1980-01-01") == ["1"]


@pytest.fixture
def tenants(spark):
    rows = [("a1", "org-a"), ("a2", "org-a"), ("b1", "org-b")]
    return spark.createDataFrame(rows, "patient_id string, organization_id string")


def test_tenant_sees_own_rows_only(tenants):
    a, b = tenancy.OrgContext("org-a"), tenancy.OrgContext("org-b")
    assert tenancy.org_scope(tenants, a).count() == 2
    assert tenancy.org_scope(tenants, b).count() == 1
    assert tenancy.org_scope(tenants, b).filter(F.col("patient_id") == "a1").count() == 0


def test_admin_sees_all(tenants):
    assert tenancy.org_scope(tenants, tenancy.OrgContext("x", frozenset({"admin"})), "any").count() == 3


@pytest.mark.parametrize("org", ["", "  ", None])
def test_empty_tenant_refused(org):
    with pytest.raises(tenancy.ScopeError):
        tenancy.OrgContext(org)


def test_scope_and_column_required(tenants):
    ctx = tenancy.OrgContext("org-a", frozenset({"patient.read"}))
    with pytest.raises(tenancy.ScopeError, match="Missing required scope"):
        tenancy.org_scope(tenants, ctx, "patient.write")
    with pytest.raises(tenancy.ScopeError, match="no organization_id"):
        tenancy.org_scope(tenants.drop("organization_id"), ctx)
