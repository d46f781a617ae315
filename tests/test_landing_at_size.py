"""What the landing and its tables cost for each document stays the same as tables grow."""

import re

import pytest
from pyspark.sql import functions as F

from medloom.functions.documents import path, with_document
from medloom.operators.validation import cast_failures
from medloom.plans import landing
from medloom.plans.clinical import Clinical
from medloom.sources.lookup import LookupTable


def test_documents_are_built_once(spark):
    df = spark.createDataFrame([('{"a":1}',), ('{"a":1} x',), ('{"a":1},"m"',)], "value string")
    read = with_document(df, "value", "doc")
    # A document taken out of a parsed pair is built twice.
    assert "$[0]" not in read._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r[0] or "" for r in read.select(F.to_json("doc")).collect()) == ["", "", '{"a":1}']


VALUES = ['"12"', '" -12 "', '"+7"', '"1-2-3"', '"a"', '""', '"1.5"', '"1."', '"99999999999999999999"', '"٣"',
          "5", "1.5", "1e3", "1e300", "true", "null", '{"b":1}', "[1]", '"300"', '"9-"']


@pytest.mark.parametrize("type_", ["bigint", "int", "tinyint", "double", "date"])
def test_cast_failures_are_those_of_a_cast(spark, type_):
    texts = [f'{{"id":{v}}}' for v in VALUES] + ["{}"]
    df = spark.createDataFrame([(t,) for t in texts], "value string").select(
        F.try_parse_json("value").alias("record_content")
    )
    present = path(".id", "variant").isNotNull() & ~F.is_variant_null(path(".id", "variant"))
    wanted = df.where(present & path(".id", type_).isNull()).count()
    counted = cast_failures(df, {".id": type_})
    assert [tuple(r) for r in counted.collect()] == [(".id", wanted)]
    if type_ == "bigint":
        # Not cast by the scan, where each failure raises.
        assert "$.id, LongType" not in counted._jdf.queryExecution().optimizedPlan().toString()
        assert "RLIKE" in counted._jdf.queryExecution().optimizedPlan().toString()


def test_ranges_grow_with_the_documents(spark, tmp_path):
    rows = 4_000
    raw = spark.range(rows).select(
        F.try_parse_json(F.concat(F.lit('{"id":"'), F.col("id"), F.lit('"}'))).alias("record_content")
    )
    table = LookupTable(spark, str(tmp_path / "t"), "patients", rows_per_file=100)
    table.add(raw, "first")
    ranges = {re.search(r"part-(\d+)", f)[1] for f in table.paths({})}
    # More than the eight shuffle partitions of this session.
    assert len(ranges) > 30
    found = spark.read.parquet(*table.paths({"id": "17"})).where(path(".id") == "17")
    assert found.count() == 1 and table.documents().count() == rows


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(landing, "ROWS_PER_BUCKET", 200)
    written, write = [], landing.write_bucketed
    monkeypatch.setattr(
        landing, "write_bucketed", lambda df, name, key, n, to: (written.append(n), write(df, name, key, n, to))
    )
    # Written once for a folder: this one has a name of its own.
    m = Clinical(spark, "/root/testdata/./sf0.001")
    marts = m.api_observation_colocated
    assert written == [-(-m.stg_observation.count() // 200)] * 2 and written[0] > landing.BUCKETS
    assert marts.count() == m.api_observation.count()
