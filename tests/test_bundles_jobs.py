import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from medloom.functions.identity import job_date_path, safe_filename, tokenize
from medloom.operators import bundles, jobs

ENTRY = {"resource": {"resourceType": "Patient", "id": "1"}}


def _error(spark, body):
    df = spark.createDataFrame([(body,)], "body string")
    return bundles.validate_bundle(df).first().error


def _bundle(**kwargs):
    return json.dumps({"resourceType": "Bundle", "type": "batch", "entry": [ENTRY], **kwargs})


@pytest.mark.parametrize(
    "body, error",
    [
        (None, "Request body is empty"),
        ("", "Request body is empty"),
        ("{nope", "Invalid JSON"),
        (_bundle(resourceType="Patient"), "Expected resourceType 'Bundle', got 'Patient'"),
        ("{}", "Expected resourceType 'Bundle', got 'None'"),
        (
            _bundle(type="searchset"),
            "Unsupported bundle type: searchset. Valid types: "
            "['transaction', 'batch', 'collection', 'message', 'document']",
        ),
        (_bundle(entry=[]), "Bundle contains no entries"),
        ('{"resourceType":"Bundle","type":"batch"}', "Bundle contains no entries"),
        (_bundle(entry=[ENTRY, {"fullUrl": "x"}]), "Entry 1 missing 'resource' field"),
        (_bundle(entry=[ENTRY, {"resource": None}]), None),
    ],
)
def test_validate_bundle(spark, body, error):
    assert _error(spark, body) == error


@pytest.mark.parametrize("kind", ["transaction", "batch", "collection", "message", "document"])
def test_all_bundle_types(spark, kind):
    assert _error(spark, _bundle(type=kind)) is None


def test_counts_two_ways(spark):
    types = ["Patient"] * 2 + ["Encounter"] + ["Observation"] * 3 + [None]
    entries = [{"resource": {"resourceType": t} if t else {"id": "x"}} for t in types]
    df = spark.createDataFrame([("r", _bundle(entry=entries))], "id string, body string")
    checked = bundles.validate_bundle(df)
    expected = {"Patient": 2, "Encounter": 1, "Observation": 3, "Unknown": 1}
    rows = bundles.count_resources(checked, ["id"]).collect()
    assert {r.resource_type: r.resource_count for r in rows} == expected
    assert checked.select(bundles.entry_type_counts().alias("m")).first().m == expected


def test_explode_passes_single_resources_and_drops_empty_ones(spark):
    texts = [
        _bundle(entry=[ENTRY, {"resource": {}}, {"fullUrl": "x"}, {"resource": {"id": "2"}}]),
        '{"resourceType":"Patient","id":"3"}',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "body string")
    df = df.select(F.try_parse_json("body").alias("bundle"))
    ids = bundles.explode_bundle(df).select(F.expr("record_content:id::string AS id")).collect()
    assert sorted(r.id for r in ids) == ["1", "2", "3"]


def test_job_id(spark):
    at = dt.datetime(2024, 1, 15, 10, 30)
    df = spark.createDataFrame([("req", at)], "request_id string, requested_at timestamp_ntz")
    stamp = "20240115103000"
    digest = hashlib.md5(f"req{stamp}".encode()).hexdigest()[:8]
    assert jobs.assign_job_id(df).first().job_id == f"job-{stamp}-{digest}"


@pytest.mark.parametrize(
    "job, expected", [("job-20240115103000-ab", "2024/01/15"), ("plain", "2025/01/01")]
)
def test_job_date_path(spark, job, expected):
    df = spark.createDataFrame([(job,)], "j string")
    now = F.lit("2025-01-01").cast("timestamp_ntz")
    assert df.select(job_date_path(F.col("j"), now)).first()[0] == expected


@pytest.mark.parametrize(
    "name, expected",
    [
        ("report.json", "report.json"),
        ("my file (1).json", "my_file__1_.json"),
        ("../../etc/passwd", ".._.._etc_passwd"),
        ("__x__", "x"),
        ("", "upload"),
        ("___", "upload"),
        ("a" * 150, "a" * 100),
        ("a" * 99 + "__b", "a" * 99),
        ("ü😀.json", ".json"),
    ],
)
def test_safe_filename(spark, name, expected):
    got = spark.createDataFrame([(name,)], "n string").select(safe_filename(F.col("n"))).first()[0]
    assert got == expected


def test_upload_manifest(spark):
    at = dt.datetime(2024, 1, 15)
    rows = [
        ("u1", None, None, None, at),
        ("u2", "a b.ndjson", "application/x-ndjson", 60, at),
        ("u3", None, "text/plain", 10, at),
        ("u4", None, "application/fhir+ndjson", 86401, at),
    ]
    schema = (
        "upload_id string, filename string, content_type string, expires_in int, "
        "requested_at timestamp_ntz"
    )
    got = {
        r.upload_id: r
        for r in jobs.upload_manifest(spark.createDataFrame(rows, schema), "in").collect()
    }
    assert got["u1"].object_key == "in/uploads/2024/01/15/u1.json"
    assert got["u2"].object_key == "in/uploads/2024/01/15/u2-a_b.ndjson"
    assert got["u3"].error.startswith("Invalid contentType 'text/plain'. Allowed types: ")
    assert got["u4"].error == "expiresIn must be an integer between 60 and 86400 seconds"
    assert got["u4"].object_key is None
    assert got["u2"].expires_in == 3600


def test_route_uploads(spark):
    rows = [
        ("incoming/fhir/org-1/2024/f.ndjson", None, None, 5),
        ("x/f.json", None, None, 5),
        ("x/f.json", "org-9", "up", 5),
    ]
    schema = "object_key string, meta_organization_id string, meta_upload_id string, size bigint"
    routed = jobs.route_uploads(spark.createDataFrame(rows, schema))
    got = [(r.organization_id, r.job_id, r.error) for r in routed.collect()]
    assert got == [
        ("org-1", "f", None),
        (None, "f", "Missing organization_id"),
        ("org-9", "up", None),
    ]
    tally = jobs.route_tally(routed).first()
    assert (tally.processed, tally.errors) == (2, 1)


def test_tokens(spark):
    rows = [("m1", "a"), ("m1", "a"), ("m1", "b"), ("m2", "a")]
    df = spark.createDataFrame(rows, "v string, o string")
    tokens = [r[0] for r in df.select(tokenize(F.col("v"), F.col("o"), "s")).collect()]
    assert tokens[0] == tokens[1] == hashlib.sha256(b"a:s:m1").hexdigest()
    assert len(set(tokens)) == 3 and len(tokens[0]) == 64
