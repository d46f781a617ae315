import json
import random

import pytest
from pyspark.sql import functions as F

from medloom.functions.documents import strict_json
from medloom.operators import validation
from medloom.sources import readers

PATIENT = '{"resourceType":"Patient","id":"1"}'


def _landed(spark, tmp_path, content, name="patients.ndjson"):
    folder = tmp_path / "landing"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(content)
    return readers.read_ndjson_lines(spark, str(folder))


def _errors(df):
    rows = validation.validate_ndjson(df).orderBy("source_file_row_number").collect()
    return [r.error for r in rows]


def test_two_valid_lines(spark, tmp_path):
    lines = _landed(spark, tmp_path, PATIENT + '\n{"resourceType":"Encounter"}\n')
    assert _errors(lines) == [None, None]


def test_bad_second_line(spark, tmp_path):
    lines = _landed(spark, tmp_path, PATIENT + "\nbad_json")
    assert _errors(lines) == [None, "Invalid JSON on line 2"]


def test_missing_type(spark, tmp_path):
    assert _errors(_landed(spark, tmp_path, '{"id":"1"}')) == ["Missing 'resourceType' on line 1"]


def test_null_type_counts_as_present(spark, tmp_path):
    assert _errors(_landed(spark, tmp_path, '{"resourceType":null}')) == [None]


def test_not_an_object(spark, tmp_path):
    lines = _landed(spark, tmp_path, '[1]\n"x"\n7\nnull')
    assert _errors(lines) == [f"Line {i} is not a JSON object" for i in (1, 2, 3, 4)]


def test_leading_blank_lines_do_not_count_but_inner_ones_do(spark, tmp_path):
    lines = _landed(spark, tmp_path, f"\n \n{PATIENT}\n\nbad\n\n")
    assert _errors(lines) == [None, "Invalid JSON on line 3"]


def test_failfast_raises_first_error(spark, tmp_path):
    lines = _landed(spark, tmp_path, f"{PATIENT}\nbad\n[1]")
    with pytest.raises(validation.InvalidInput, match="Invalid JSON on line 2"):
        validation.validate_ndjson(lines, "failfast")


def test_windows_line_ends(spark, tmp_path):
    lines = _landed(spark, tmp_path, f"{PATIENT}\r\n{PATIENT}\r\n")
    assert _errors(lines) == [None, None]


@pytest.mark.parametrize(
    "text, valid",
    [
        ('{"a":1}', True),
        (' {"a":1} ', True),
        ("1", True),
        ("null", True),
        ('{"a":1} x', False),
        ('{"a":1}{"b":2}', False),
        ('{"a":1}]', False),
        ('{"a":1}] [x', False),
        ('{"a":1},{"b":1}', False),
        ('{"a":1},"x"]', False),
        ("", False),
        ("{", False),
        ('{"a":"]"}', True),
        ('{"a":"\\"]"}', True),
    ],
)
def test_strict_json(spark, text, valid):
    df = spark.createDataFrame([(text,)], "value string")
    assert df.select(strict_json("value").isNotNull()).first()[0] is valid


def test_repeated_key_last_wins(spark):
    df = spark.createDataFrame([('{"a":1,"a":2}',)], "value string")
    got = df.select(F.try_variant_get(strict_json("value"), "$.a", "int")).first()[0]
    assert got == 2


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"resourceType":"P"}', '{"resourceType":"P","meta":{}}'),
        ('{"meta":{"x":1}}', '{"meta":{"x":1}}'),
        ('{"meta":null}', '{"meta":null}'),
        ("{}", '{"meta":{}}'),
        ("{ }", '{"meta":{}}'),
        ('{"v":1.50} ', '{"v":1.50,"meta":{}}'),
        ('{"a":"{"}', '{"a":"{","meta":{}}'),
    ],
)
def test_default_meta(spark, text, expected):
    df = spark.createDataFrame([(text,)], "value string")
    df = df.withColumn("record_content", strict_json("value"))
    assert validation.add_default_meta(df).first().value == expected


def test_one_bad_line_keeps_the_file_out(spark, tmp_path):
    _landed(spark, tmp_path, f"{PATIENT}\nbad", "a.ndjson")
    lines = _landed(spark, tmp_path, f"{PATIENT}\n{PATIENT}", "b.ndjson")
    valid, failed = validation.split_valid_quarantine_files(validation.validate_ndjson(lines))
    assert valid.count() == 2
    assert [r.error for r in failed.collect()] == ["Invalid JSON on line 2"]
    assert all("meta" in json.loads(r.value) for r in valid.collect())


@pytest.mark.parametrize("limit", [0, 10])
def test_row_numbers_across_splits(spark, tmp_path, limit, monkeypatch):
    """One file far larger than a split, one hot file among small ones, both join ways."""
    monkeypatch.setattr(readers, "BROADCAST_SPLITS", limit)
    folder = tmp_path / "big"
    folder.mkdir()
    expected = {}
    for name, n in {"hot": 5000, "small": 3, "other": 40}.items():
        lines = ["", ""] + [json.dumps({"resourceType": "Patient", "n": i}) for i in range(n)]
        (folder / f"{name}.ndjson").write_text("\n".join(lines) + "\n")
        expected[name] = {(i, i + 3) for i in range(n)}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        raw = readers.read_ndjson_raw(spark, str(folder), "x", name_pattern=r".*\.ndjson")
        assert raw.rdd.getNumPartitions() > 1
        got = raw.select(
            F.regexp_extract("source_file", r"/(\w+)\.ndjson", 1).alias("f"),
            F.try_variant_get("record_content", "$.n", "int").alias("n"),
            "source_file_row_number",
        ).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, pairs in expected.items():
        assert {(r.n, r.source_file_row_number) for r in got if r.f == name} == pairs


def test_random_damage_against_a_plain_parser(spark):
    """Texts damaged at random places are accepted exactly when Python's parser accepts them."""
    rng = random.Random(11)
    seeds = [
        json.dumps({"resourceType": "Patient", "n": [1, -2.5, 1e3, None, True], "t": 'q"\\ü]}'}),
        json.dumps({"a": {"b": [{"c": []}, {}]}, "d": ""}),
        json.dumps([{"x": 1}, "y"]),
    ]
    texts = set(seeds)
    while len(texts) < 1500:
        text = rng.choice(seeds)
        for _ in range(rng.randint(1, 3)):
            at = rng.randrange(len(text) + 1)
            piece = rng.choice(['"', "}", "]", "{", "[", ",", ":", " ", "0", "1", "x", "\\", "}]", '"}', ""])
            text = text[:at] + piece + text[at + rng.randint(0, 2) :]
        texts.add(text)

    def accepted(text):
        try:
            json.loads(text)
            return True
        except ValueError:
            return False

    df = spark.createDataFrame([(t,) for t in sorted(texts)], "value string")
    got = df.select("value", strict_json("value").isNotNull().alias("ok")).collect()
    wrong = [r.value for r in got if r.ok is not accepted(r.value)]
    assert wrong == []
    assert 50 < sum(r.ok for r in got) < len(got) - 50
