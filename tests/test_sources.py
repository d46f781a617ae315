import csv as plain_csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from medloom.functions.documents import path
from medloom.sources import csv, readers, writers


def test_bundle_and_resource_files(spark, tmp_path):
    entry = {"entry": [{"resource": {"id": "1"}}, {"resource": {"id": "2"}}]}
    (tmp_path / "b1.json").write_text(json.dumps(entry, indent=2))
    (tmp_path / "b2.json").write_text('{"resourceType":"Bundle"}')
    rows = readers.read_bundle(spark, [str(tmp_path / "b1.json"), str(tmp_path / "b2.json")])
    assert sorted(r[0] for r in rows.select(path(".id")).collect()) == ["1", "2"]
    (tmp_path / "patient_1.json").write_text('{\n "id": "p"\n}')
    rows = readers.read_resource_files(spark, str(tmp_path))
    assert [r[0] for r in rows.select(path(".id")).collect()] == ["p"]


def test_raw_takes_files_of_its_resource_only(spark, tmp_path):
    for name in ("patients.ndjson", "patients_001.ndjson", "encounters.ndjson", "patients.txt"):
        (tmp_path / name).write_text('{"id":"1"}\n')
    raw = readers.read_ndjson_raw(spark, str(tmp_path), "patients")
    assert raw.count() == 2
    assert raw.columns == [
        "record_content", "ingestion_time", "source_file", "source_file_row_number",
    ]


def test_omop_csv_types(spark, tmp_path):
    (tmp_path / "person.csv").write_text(
        "person_id,gender_concept_id,year_of_birth,month_of_birth,extra\n"
        "1,8507,1980,5.0,x\n2,8532,unknown,,y\n"
    )
    df, failed = readers.read_omop_csv(spark, str(tmp_path / "person.csv"), "person")
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    assert failed == {"year_of_birth": 1}
    assert types == {
        "person_id": "bigint",
        "gender_concept_id": "bigint",
        "year_of_birth": "string",
        "month_of_birth": "bigint",
        "extra": "string",
    }
    assert [r.month_of_birth for r in df.orderBy("person_id").collect()] == [5, None]


def test_convert_dir_goes_on_after_an_error(spark, tmp_path, monkeypatch):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "person.csv").write_text("person_id\n1\n2\n")
    (source / "broken.csv").write_text("a\n1\n")
    (source / "extra.csv").mkdir()
    (source / "extra.csv" / "1.csv").write_text("a\n1\n")
    (source / "extra.csv" / "2.csv").write_text("a\n2\n")
    opened = readers.OmopCsv.open

    def fail_on_broken(spark, path_, table):
        if table == "broken":
            raise OSError("cannot read")
        return opened(spark, path_, table)

    monkeypatch.setattr(readers.OmopCsv, "open", fail_on_broken)
    report = {r.table: r for r in readers.convert_omop_dir(spark, str(source), str(target)).collect()}
    assert {t: (r.rows, r.error) for t, r in report.items()} == {
        "person": (2, None), "broken": (None, "OSError: cannot read"), "extra": (2, None),
    }
    written = spark.read.parquet(report["person"].output)
    assert written.schema[0].dataType.simpleString() == "bigint"


def test_manifest(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}")
    (tmp_path / "b.txt").write_text("{}")
    files = readers.source_manifest(spark, str(tmp_path)).collect()
    assert [(r.path.rsplit("/", 1)[1], r.length) for r in files] == [("a.json", 2)]
    with pytest.raises(ValueError, match="no files"):
        readers.source_manifest(spark, str(tmp_path), "*.xml")


def test_bundles_hold_everything_once(spark, tmp_path):
    df = spark.range(0, 1003, 1, 3).select(F.format_string('{"id":"%d"}', "id").alias("value"))
    writers.write_bundle(df, str(tmp_path / "b"), size=100)
    sizes = spark.read.text(str(tmp_path / "b")).select(
        F.size(path(".entry", "array<variant>", F.try_parse_json("value")))
    )
    assert max(r[0] for r in sizes.collect()) == 100
    ids = readers.read_bundle(spark, str(tmp_path / "b")).select(path(".id", "int")).collect()
    assert sorted(r[0] for r in ids) == list(range(1003))


def test_bundle_of_an_empty_frame(spark, tmp_path):
    df = spark.createDataFrame([], "value string")
    writers.write_bundle(df, str(tmp_path / "b"))
    assert readers.read_bundle(spark, str(tmp_path / "b")).count() == 0


def test_ndjson_keeps_names_and_order(spark, tmp_path):
    rows = [(f'{{"n":{i}}}', "s3/landing/a.ndjson", i) for i in range(500, 0, -1)]
    df = spark.createDataFrame(rows, "value string, source_file string, source_file_row_number bigint")
    writers.write_ndjson(df.coalesce(1), str(tmp_path / "p"))
    assert (tmp_path / "p" / "file=a.ndjson").is_dir()
    text = next((tmp_path / "p" / "file=a.ndjson").glob("part-*")).read_text()
    assert [json.loads(line)["n"] for line in text.split()] == list(range(1, 501))


def test_by_type_and_date_skips_other_types(spark, docs, tmp_path):
    raw = docs(*['{"resourceType":"Patient"}'] * 2, '{"resourceType":"Encounter"}', '{"id":"x"}')
    counts = writers.write_by_type_and_date(
        raw, ["Patient", "Observation"], str(tmp_path / "t"), F.lit("2024-01-15").cast("date")
    )
    assert [tuple(r) for r in counts.collect()] == [("Patient", 2)]
    assert (tmp_path / "t" / "resource_type=Patient" / "date=2024-01-15").is_dir()


def test_omop_layout(spark, tmp_path):
    df = spark.createDataFrame([("c", "2024-01-15")], "condition_occurrence_id string, condition_start_date string")
    writers.write_omop_partitioned(df, "condition_occurrence", str(tmp_path / "c"))
    assert (tmp_path / "c" / "condition_start_date=2024-01-15").is_dir()


def test_raw_table_paths_are_read_as_leaves(spark, docs, tmp_path):
    raw = docs('{"id":"1","a":{"b":[{"c":2}]}}', '{"id":"2","a":7}')
    writers.write_raw_table(raw, str(tmp_path / "raw"))
    df = spark.read.parquet(str(tmp_path / "raw")).select(path(".id"), path(".a.b[0].c", "int"))
    assert sorted(tuple(r) for r in df.collect()) == [("1", 2), ("2", None)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<record_content:struct<0:string,1:int>>" in plan


def test_csv_quotes_line_ends_and_missing_values(spark, tmp_path):
    (tmp_path / "person.csv").write_text(
        'person_id,gender_concept_id,year_of_birth,note\n'
        '1,8507,1950,"line one\nline two"\n'
        '2,8532.0,NA,"say ""hi"", ok"\n'
        '3,,1970,null\n'
    )
    df, failed = readers.read_omop_csv(spark, str(tmp_path / "person.csv"), "person")
    assert failed == {}
    rows = [tuple(r) for r in df.orderBy("person_id").collect()]
    assert rows == [(1, 8507, 1950, "line one\nline two"), (2, 8532, None, 'say "hi", ok'), (3, None, 1970, None)]


def test_csv_broken_records_are_counted_or_fail(spark, tmp_path):
    import pytest

    (tmp_path / "person.csv").write_text("person_id,year_of_birth\n1,1950\n2,1960,9\n3\n")
    df, failed = readers.read_omop_csv(spark, str(tmp_path / "person.csv"), "person")
    assert failed == {readers.BROKEN: 2} and df.count() == 3
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_omop_csv(spark, str(tmp_path / "person.csv"), "person", multi_line=False)


def random_csv(rng, rows):
    """Text of a file, and its cells as Python's own reader takes them."""
    pieces = ["plain", "", "a,b", 'say ""hi""', "two\nlines", "\n\n", '""', "x\r\ny", " padded ", "é😀", ",", "\n"]
    lines = ["id,a,b"]
    for k in range(rows):
        cells = [rng.choice(pieces) + rng.choice(pieces) for _ in range(2)]
        quoted = [f'"{c}"' if set(c) & set(',"\n\r') or rng.random() < 0.3 else c for c in cells]
        lines.append(f"{k},{','.join(quoted)}")
        if rng.random() < 0.1:
            lines.append(rng.choice(["", "  ", "\t"]))
    return rng.choice(["\n", "\r\n"]).join(lines) + rng.choice(["", "\n"])


@pytest.mark.parametrize("size, few", [(150, True), (1500, True), (1500, False), (1 << 20, True)])
def test_quoted_csv_is_read_by_many_tasks(spark, tmp_path, monkeypatch, size, few):
    """Splits of any size, starting inside cells or not, give the records of a plain reader."""
    if not few:
        monkeypatch.setattr(csv, "BROADCAST_SPLITS", 0)
    rng = random.Random(size)
    folder, want = tmp_path / "extra.csv", []
    folder.mkdir()
    for k, rows in enumerate((0, 1, 40, 160)):
        text = random_csv(rng, rows)
        (folder / f"{k}.csv").write_bytes(text.encode())
        cells = list(plain_csv.reader(io.StringIO(text, newline=""), strict=True))
        want += [tuple(c or None for c in row) for row in cells[1:] if row and (len(row) == 3)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        records = csv.csv_records(spark, str(folder))
        df, failed = readers.read_omop_csv(spark, str(folder), "extra")
        got = [tuple(r) for r in df.collect()]
        if size < 10_000:
            assert records.rdd.getNumPartitions() >= 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert failed == {}
    assert sorted(got, key=str) == sorted(want, key=str)


def test_a_quote_that_is_never_closed(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,2\n3,"x\n4,5\n')
    records = csv.csv_records(spark, str(tmp_path / "t.csv")).collect()
    assert sorted((r.record, r.header) for r in records) == [("1,2", False), ('3,"x\n4,5', False), ("a,b", True)]


def test_unfit_columns_are_found_while_writing(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "person.csv").write_text('person_id,year_of_birth,month_of_birth\n1,1950,1\n2,"19\n60",2\n3,x,\n')
    (row,) = readers.convert_omop_dir(spark, str(source), str(tmp_path / "out")).collect()
    assert (row.table, row.rows, row.unfit_columns, row.error) == ("person", 3, ["year_of_birth"], None)
    back = spark.read.parquet(row.output)
    assert [tuple(r) for r in back.orderBy("person_id").collect()] == [(1, "1950", 1), (2, "19\n60", 2), (3, "x", None)]
