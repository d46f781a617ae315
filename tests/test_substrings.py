"""Searches for a part of a text through posting lists: the rows of a scan from few candidates."""

import random

import pytest
from pyspark.sql import functions as F

from medloom.operators.search import search_patients
from medloom.sources import substrings
from medloom.sources.substrings import SubstringIndex


@pytest.fixture(scope="module")
def people(spark):
    rng = random.Random(9)
    parts = ["Ann", "Bob", "Meyer", "Ötzi", "Σοφία", "von", "O'Neil", "İpek", "x"]
    names = [" ".join(rng.choices(parts, k=rng.randrange(1, 4))) + f" {rng.randrange(500)}" for _ in range(1500)]
    rows = [(str(k), n) for k, n in enumerate(names)] + [("a", None), ("b", ""), ("c", "An"), ("d", "50%_\\x"), (None, "Ann")]
    return spark.createDataFrame(rows, "patient_id string, name_search_index string").withColumns(
        {"gender": F.lit("female"), "updated_at": F.lit("2025-01-01").cast("timestamp_ntz")}
    ).cache()


@pytest.fixture(scope="module")
def names(spark, people, tmp_path_factory):
    index = SubstringIndex(spark, str(tmp_path_factory.mktemp("names")))
    index.build(people, "patient_id", "name_search_index")
    return index


NAMES = ["ann bob", "ÖTZI", "σοφ", "neil 49", "İPEK", "nobody", "an", "a%bob 1", "mey_r", "%_\\x", "_"]


@pytest.mark.parametrize("name, listed", [*((n, 1000) for n in NAMES), ("ann bob", 0), ("nobody", 0), ("a%bob 1", 0)])
def test_searches_are_those_of_a_scan(monkeypatch, people, names, name, listed):
    monkeypatch.setattr(substrings, "LISTED_IDS", listed)
    params = {"name": name, "_count": "1000"}
    found = search_patients(people, params, names)
    want = search_patients(people, params)
    assert sorted(map(str, found.collect())) == sorted(str(r) for r in want.collect() if r.patient_id is not None or len(name) < 3)


def test_candidates_are_few(people, names):
    found = {r.id for r in names.candidates("neil 49").collect()}
    want = {r.patient_id for r in people.where("name_search_index ILIKE '%neil 49%'").collect()}
    assert want <= found and len(found) <= len(want) + 5 < 100
    assert names.candidates("zzz").count() == 0 and names.candidates("an") is None and names.candidates("a_b%c") is None
