"""Searches, paging and tenant scoping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.functions.documents import path
from medloom.operators import search, tenancy
from medloom.plans.catalog.base import Query, sql
from medloom.session import scratch_dir
from medloom.sources.substrings import SubstringIndex

_ENC = "encounter_id AS id, strftime(period_start, '%Y-%m-%dT%H:%M:%SZ') AS sort_key, status"
_OBS = "observation_id AS id, strftime(effective_datetime, '%Y-%m-%dT%H:%M:%SZ') AS sort_key, code"


def _encounters(page: DataFrame) -> DataFrame:
    return page.select("id", "sort_key", path(".status").alias("status"))


def _observations(page: DataFrame) -> DataFrame:
    return page.select("id", "sort_key", path(".code.coding[0].code").alias("code"))


_ENC_PARAMS = {"patient": "1", "status": "finished", "class": "AMB", "_count": "50"}
_ENC_WHERE = "o_custkey::VARCHAR LIKE '1%' AND status = 'finished' AND class_code = 'AMB'"
_OBS_PARAMS = {
    "patient": "4",
    "code": "2339-0, 8867-4",
    "category": "laboratory",
    "status": "final",
    "_count": "40",
    "_offset": "10",
}
_OBS_WHERE = """o_custkey::VARCHAR LIKE '4%' AND code IN ('2339-0', '8867-4')
    AND category_code = 'laboratory' AND status = 'final'"""


def get_by_id(resource: str, id_: str):
    def run(m):
        found = search.get_by_id(m.find(resource, {"id": id_}), id_)
        return found.select(path(".id").alias("id"), F.to_json("record_content").alias("document"))

    return run


def get_observation(m):
    """Asks for the smallest id there is."""
    ids = m.raw("observations").select(path(".id").alias("id")).where("id IS NOT NULL")
    # One row kept per task; a least text by an aggregate takes several times as long.
    least = ids.orderBy("id").limit(1).first()
    smallest = least[0] if least else None
    return search.get_by_id(m.find("observations", {"id": smallest}), smallest).select(
        path(".id").alias("id"), path(".status").alias("status"), path(".issued").alias("issued")
    )


def _people(m):
    return m.tenant_raw("patients").select(
        path(".id").alias("patient_id"),
        path(".identifier[0].value").alias("external_identifier"),
        path(".gender").alias("gender"),
        path(".birthDate", "date").alias("birth_date"),
        path(".name[0].family").alias("name_search_index"),
        F.col("ingestion_time").cast("timestamp_ntz").alias("updated_at"),
        "organization_id",
    )


def search_patients(m):
    params = {"gender": "FEMALE", "name": "CUSTOMER#0000", "_count": "30"}
    return search.search_patients(_people(m), params)


def search_patients_indexed(m):
    """A part of a name through posting lists."""
    names = SubstringIndex(m.spark, scratch_dir(m.spark, "names"))
    names.build(_people(m), "patient_id", "name_search_index")
    return search.search_patients(_people(m), {"name": "0001_", "_count": "1000"}, names)


_ctx = tenancy.OrgContext("org-2", frozenset({"patient.read"}))


def org_scope(m):
    scoped = tenancy.org_scope(m.tenant_raw("patients"), _ctx, "patient.read")
    return scoped.select(path(".id").alias("patient_id"), "organization_id")


def org_scoped_search(m):
    page = tenancy.org_scoped(
        search.search_encounters, m.tenant_raw("encounters"), _ctx, {"status": "planned"}
    )
    return _encounters(page)


def org_scoped_by_id(m):
    """Every patient asked for from another tenant: nothing may come back."""
    other = tenancy.org_scope(m.tenant_raw("patients"), tenancy.OrgContext("org-1"))
    wanted = other.select(path(".id").alias("patient_id"))
    mine = tenancy.org_scope(m.tenant_raw("patients"), _ctx).select(path(".id").alias("patient_id"))
    return mine.join(wanted, "patient_id", "left_semi")


def search_bundle(m):
    found = m.find("encounters", _ENC_PARAMS)
    bundle = search.search_bundle(found, "encounter", _ENC_PARAMS)
    doc = F.try_parse_json("bundle")
    entries = F.try_variant_get(doc, "$.entry", "array<variant>")
    return bundle.select(
        F.try_variant_get(doc, "$.type", "string").alias("type"),
        F.try_variant_get(doc, "$.total", "bigint").alias("total"),
        F.array_join(
            F.transform(entries, lambda e: F.try_variant_get(e, "$.resource.id", "string")), ","
        ).alias("ids"),
    )


def _enc_search(params: dict[str, str], **kwargs):
    return lambda m: _encounters(
        search.search_encounters(m.find("encounters", params, **kwargs), params, **kwargs)
    )


def _page_sql(columns: str, source: str, where: str, key: str, count: int, offset: int = 0) -> str:
    id_ = columns.split(" ", 1)[0]
    return sql(
        f"""SELECT {columns} FROM {source} WHERE {where}
            ORDER BY {key} DESC NULLS FIRST, {id_} LIMIT {count} OFFSET {offset}""",
        source,
    )


def _enc_sql(where: str, count: int = 100, offset: int = 0) -> str:
    return _page_sql(_ENC, "enc", where, "period_start", count, offset)


def _obs_sql(where: str, count: int = 100, offset: int = 0) -> str:
    return _page_sql(_OBS, "obs", where, "effective_datetime", count, offset)


QUERIES: dict[str, Query] = {
    "get_patient_by_id": Query(
        get_by_id("patients", "42"),
        sql(
            """SELECT patient_id AS id,
                      '{"active":' || active::VARCHAR || ',"address":[{"city":"' || city
                      || '","country":"US","postalCode":"' || postal_code || '","state":"' || state
                      || '"}],"birthDate":"' || birth_date::VARCHAR
                      || '","communication":[{"language":{"coding":[{"code":"en"}]}}]'
                      || ',"extension":[{"url":"urn:omop:person-id","valueInteger":42}]'
                      || ',"gender":"' || gender || '","id":"42"'
                      || ',"identifier":[{"system":"urn:mrn","type":{"coding":[{"code":"MR"}]}'
                      || ',"value":"MRN42"},{"system":"http://hl7.org/fhir/sid/us-SSN"'
                      || ',"value":"000000042"},{"system":"urn:plan","value":"' || c_mktsegment
                      || '"}],"managingOrganization":{"reference":"Organization/'
                      || organization_id || '"},"meta":{"source":"synthetic"}'
                      || ',"resourceType":"Patient"}' AS document
               FROM pat WHERE patient_id = '42' LIMIT 1""",
            "pat",
        ),
    ),
    "get_encounter_by_id": Query(
        lambda m: _encounters(
            search.get_by_id(m.find("encounters", {"id": "77"}), "77").select(
                path(".id").alias("id"), path(".period.start").alias("sort_key"), "record_content"
            )
        ),
        sql(f"SELECT {_ENC} FROM enc WHERE encounter_id = '77' LIMIT 1", "enc"),
    ),
    "get_observation_by_id": Query(
        get_observation,
        sql(
            """SELECT observation_id AS id, status,
                      strftime(issued, '%Y-%m-%dT%H:%M:%SZ') AS issued
               FROM obs ORDER BY observation_id LIMIT 1""",
            "obs",
        ),
    ),
    "search_encounters": Query(_enc_search(_ENC_PARAMS), _enc_sql(_ENC_WHERE, 50)),
    "search_encounters_exact": Query(
        _enc_search({"patient": "1"}, exact_patient=True), _enc_sql("o_custkey = 1")
    ),
    "search_encounters_by_date": Query(
        _enc_search({"date": "1998-10", "_count": "5000"}),
        _enc_sql("strftime(period_start, '%Y-%m') = '1998-10'", 1000),
    ),
    "search_observations": Query(
        lambda m: _observations(
            search.search_observations(m.find("observations", _OBS_PARAMS), _OBS_PARAMS)
        ),
        _obs_sql(_OBS_WHERE, 40, 10),
    ),
    "search_patients": Query(
        search_patients,
        sql(
            """SELECT patient_id, 'MRN' || patient_id AS external_identifier, gender, birth_date,
                      name_family AS name_search_index,
                      TIMESTAMP '2025-01-01 00:00:00' AS updated_at, organization_id
               FROM pat WHERE gender = 'female' AND name_family ILIKE '%CUSTOMER#0000%'
               ORDER BY updated_at DESC, patient_id LIMIT 30""",
            "pat",
        ),
    ),
    "search_patients_indexed": Query(
        search_patients_indexed,
        sql(
            """SELECT patient_id, 'MRN' || patient_id AS external_identifier, gender, birth_date,
                      name_family AS name_search_index,
                      TIMESTAMP '2025-01-01 00:00:00' AS updated_at, organization_id
               FROM pat WHERE name_family ILIKE '%0001_%'
               ORDER BY updated_at DESC, patient_id LIMIT 1000""",
            "pat",
        ),
    ),
    "search_encounters_by_day": Query(
        lambda m: search.search_encounters_by_day(
            m.api_encounter, {"status": "finished", "date": "1998-10-03"}
        ).select("encounter_id", "period_start", "duration_hours"),
        sql(
            """SELECT encounter_id, period_start,
                      date_diff('hour', period_start, period_end) AS duration_hours
               FROM enc WHERE status = 'finished' AND period_start::DATE = DATE '1998-10-03'
               ORDER BY period_start DESC, encounter_id LIMIT 100""",
            "enc",
        ),
    ),
    "search_observations_by_day": Query(
        lambda m: search.search_observations_by_day(
            m.api_observation, {"date": "1999-04-14", "code": "2339-0,39156-5"}
        ).select("observation_id", "effective_datetime", "code", "encounter_class"),
        sql(
            """SELECT observation_id, effective_datetime, code, class_display AS encounter_class
               FROM obs LEFT JOIN enc USING (encounter_id)
               WHERE effective_datetime::DATE = DATE '1999-04-14'
                     AND code IN ('2339-0', '39156-5')
               ORDER BY effective_datetime DESC, observation_id LIMIT 100""",
            "obs",
            "enc",
        ),
    ),
    "search_total": Query(
        lambda m: search.search_total(
            m.find("observations", _OBS_PARAMS), "observation", _OBS_PARAMS
        ),
        sql(f"SELECT count(*) AS total FROM obs WHERE {_OBS_WHERE}", "obs"),
    ),
    "paginate": Query(
        lambda m: search.paginate(
            m.stg_encounter.select("encounter_id", "patient_id"),
            search.Page.of({"_count": "5000", "_offset": "700"}),
            [F.col("patient_id").asc(), F.col("encounter_id").asc()],
        ),
        sql(
            """SELECT encounter_id, patient_id FROM enc
               ORDER BY patient_id, encounter_id LIMIT 1000 OFFSET 700""",
            "enc",
        ),
    ),
    "order_desc_page": Query(
        lambda m: search.order_desc_page(
            m.stg_observation.select("observation_id", "effective_datetime"),
            "effective_datetime",
            "observation_id",
            search.Page(200, 50),
        ),
        sql(
            """SELECT observation_id, effective_datetime FROM obs
               ORDER BY effective_datetime DESC NULLS FIRST, observation_id
               LIMIT 200 OFFSET 50""",
            "obs",
        ),
    ),
    "patient_encounters": Query(
        lambda m: _encounters(search.patient_encounters(m.find("encounters", {"patient": "12"}), "12")),
        _enc_sql("o_custkey::VARCHAR LIKE '12%'"),
    ),
    "patient_observations": Query(
        lambda m: _observations(
            search.patient_observations(
                m.find("observations", {"patient": "12"}), "12", code="39156-5", count=60
            )
        ),
        _obs_sql("o_custkey::VARCHAR LIKE '12%' AND code = '39156-5'", 60),
    ),
    "vital_signs": Query(
        lambda m: _observations(search.vital_signs(m.find("observations", {"patient": "7"}), "7")),
        _obs_sql("o_custkey::VARCHAR LIKE '7%' AND category_code = 'vital-signs'"),
    ),
    "lab_results": Query(
        lambda m: _observations(search.lab_results(m.find("observations", {"patient": "7"}), "7", 25, 5)),
        _obs_sql("o_custkey::VARCHAR LIKE '7%' AND category_code = 'laboratory'", 25, 5),
    ),
    "to_searchset_bundle": Query(
        search_bundle,
        sql(
            f"""SELECT 'searchset' AS type,
                       (SELECT count(*) FROM enc WHERE {_ENC_WHERE}) AS total,
                       string_agg(id, ',' ORDER BY sort_key DESC, id) AS ids
                FROM (SELECT {_ENC} FROM enc WHERE {_ENC_WHERE}
                      ORDER BY period_start DESC, encounter_id LIMIT 50)""",
            "enc",
        ),
    ),
    "org_scope": Query(
        org_scope,
        sql("SELECT patient_id, organization_id FROM pat WHERE organization_id = 'org-2'", "pat"),
    ),
    "org_scoped_search": Query(
        org_scoped_search, _enc_sql("service_provider_id = 'org-2' AND status = 'planned'")
    ),
    "org_scoped_by_id": Query(
        org_scoped_by_id,
        sql(
            """SELECT patient_id FROM pat WHERE organization_id = 'org-2' AND patient_id IN
               (SELECT patient_id FROM pat WHERE organization_id = 'org-1')""",
            "pat",
        ),
    ),
}
