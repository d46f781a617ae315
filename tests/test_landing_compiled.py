"""The landing's costs for each document: parsed in compiled code, hashed once, no case changed."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.functions.documents import strict_json, with_document
from medloom.operators.validation import validate_ndjson
from medloom.plans import fixtures
from medloom.sources.readers import read_ndjson_lines

SF = "/root/testdata/sf0.001"


def test_documents_are_parsed_in_compiled_code_and_hashed_once(spark, tmp_path):
    (tmp_path / "patients.ndjson").write_text('{"resourceType":"Patient","id":"1"}\n{"id":\n')
    checked = validate_ndjson(read_ndjson_lines(spark, str(tmp_path)))
    valid = checked.where("error IS NULL").select("record_content")
    execution = valid._jdf.queryExecution()
    assert execution.optimizedPlan().toString().count("md5(") == 1
    valid.collect()
    plan = execution.executedPlan().toString().split("== Initial Plan ==")[0]
    generated = [line for line in plan.split("\n") if "Generate " in line]
    # A star marks what is compiled with its neighbours.
    assert len(generated) == 2 and all("*(" in line for line in generated)
    assert [r[0] for r in valid.select(F.to_json("record_content")).collect()] == ['{"id":"1","resourceType":"Patient"}']


def test_documents_are_those_of_strict_json(spark):
    texts = [
        '{"a":1}', ' {"a":[1,{"b":null}]} ', '{"a":1} x', '{"a":1},{"b":2}', '{"a":1}] x', '{"a":1},"m"] x',
        "[1]", "1", '"x"', "null", "", "  ", "{", '{"a":NaN}', '{"a":1,"a":2}', None,
    ]
    fields = [T.StructField("a.b", T.IntegerType()), T.StructField("value", T.StringType())]
    df = spark.createDataFrame(list(enumerate(texts)), T.StructType(fields))
    read = with_document(df, "value", "doc")
    assert read.columns == ["a.b", "value", "doc"]
    got = read.select("`a.b`", F.to_json("doc")).collect()
    wanted = df.select("`a.b`", F.to_json(strict_json("value"))).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, wanted))
    assert sum(r[1] is not None for r in got) == 7


def test_categories_are_shown_in_capitals_without_a_change_of_case_for_each_row(spark):
    documents = fixtures.observation_documents(spark, SF)
    assert "upper(" not in documents._jdf.queryExecution().optimizedPlan().toString()
    coding = F.try_parse_json("value").alias("d")
    code, display = (f"try_variant_get(d, '$.category[0].coding[0].{x}', 'string')" for x in ("code", "display"))
    pairs = documents.select(coding).selectExpr(code, display).distinct().collect()
    assert len(pairs) == 9 and all(shown == c.upper() for c, shown in pairs)
