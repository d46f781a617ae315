"""Look-ups that choose files: the rows of a full scan from few files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from medloom.functions.documents import path
from medloom.operators import search
from medloom.sources.lookup import LookupTable

FILES = 40


def encounter(id_, patient, day):
    doc = {"resourceType": "Encounter", "id": str(id_), "status": "finished", "period": {"start": f"{day}T08:00:00Z"}}
    return doc | ({"subject": {"reference": patient}} if patient else {})


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rng = random.Random(4)
    days = [f"2024-{m:02d}-{d:02d}" for m in range(1, 13) for d in range(1, 29)]
    docs = [encounter(k, f"Patient/{rng.randrange(400)}", rng.choice(days)) for k in range(3000)]
    docs += [encounter(5000 + k, "Patient/77", "2024-05-05") for k in range(1500)]  # a hot patient
    docs += [encounter(7000, None, "2024-01-01"), encounter(7001, "https://x/Patient/9?a", "2024-01-01")]
    docs += [encounter(7002, "Patient/zz/Patient/12", "2024-01-01"), encounter(7003, "Group/12", "2024-01-01")]
    docs += [{"resourceType": "Encounter"}, encounter("50%_\\1", "Patient/50%_\\1", "2024-01-01")]
    rng.shuffle(docs)
    folder = str(tmp_path_factory.mktemp("lookup"))
    for batch, own in (("one", docs[:3000]), ("two", docs[3000:])):
        raw = spark.createDataFrame([(json.dumps(d),) for d in own], "value string").repartition(4).select(
            F.try_parse_json("value").alias("record_content"), F.lit("f").alias("source_file")
        )
        LookupTable(spark, folder, "encounters", rows_per_file=4500 // FILES).add(raw, batch)
    return LookupTable(spark, folder, "encounters", rows_per_file=4500 // FILES)


def bag(df):
    return sorted(r[0] or "" for r in df.select(path(".id")).collect())


def test_ids_come_from_few_files(table):
    raw = table.documents()
    total = len(raw.inputFiles())
    assert total >= FILES and raw.count() == 4506
    read = []
    for id_ in ("0", "17", "2999", "5001", "7003", "50%_\\1", "nobody", "-1"):
        found = table.pruned({"id": id_})
        assert bag(search.get_by_id(found, id_)) == bag(search.get_by_id(raw, id_))
        read.append(len(table.paths({"id": id_})))
        if read[-1]:
            assert len(found.inputFiles()) == read[-1]
    assert max(read) <= total // 5 and sum(read) <= total // 2


@pytest.mark.parametrize(
    "params, exact, most",
    [
        ({"patient": "33"}, True, 6),
        ({"patient": "33"}, False, 8),
        ({"patient": "77"}, True, 20),
        ({"patient": "12"}, False, 8),
        ({"patient": "9"}, False, 16),
        ({"patient": "399", "date": "2024-05"}, False, 6),
        ({"patient": "nobody"}, True, 0),
        ({"patient": "3_"}, False, 30),
        ({"patient": "50%_\\1"}, True, 4),
        ({"patient": "50%_\\1"}, False, 8),
        ({"date": "2025"}, False, 0),
        ({"date": "2024-05-05"}, False, 99),
        ({"status": "finished"}, False, 99),
        ({}, False, 99),
    ],
)
def test_searches_are_those_of_a_scan(table, params, exact, most):
    found = table.pruned(params, exact)
    asked = {**params, "_count": "1000"}
    for limit in ({"_offset": "0"}, {"_offset": "1000"}):
        page, scan = (search.search_encounters(df, asked | limit, exact) for df in (found, table.documents()))
        assert [r.id for r in page.collect()] == [r.id for r in scan.collect()]
    totals = [search.search_total(df, "encounter", params, exact).first()[0] for df in (found, table.documents())]
    assert totals[0] == totals[1]
    assert len(table.paths(params, exact)) <= most


def test_a_batch_shows_when_it_is_complete(spark, table, tmp_path):
    raw = table.documents().limit(20)
    own = LookupTable(spark, str(tmp_path), "encounters", 10)
    own.add(raw, "a")
    before = bag(own.documents())
    # Data of an attempt that never came to its index.
    raw.write.parquet(str(tmp_path / "data" / "b"))
    assert bag(own.documents()) == before
    own.add(raw, "b")
    own.add(raw, "b")  # a replay
    assert len(bag(own.documents())) == 40


def test_patients_by_id(spark, docs, tmp_path):
    own = LookupTable(spark, str(tmp_path), "patients")
    own.add(docs('{"id":"1"}', '{"id":"2"}', "{}"), "a")
    assert bag(own.pruned({"id": "2"})) == ["", "1", "2"] and own.paths({"id": "3"}) == []
    assert own.pruned({"id": "3"}).count() == 0
