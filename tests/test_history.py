"""Merges that rewrite only the buckets they touch."""

import pytest

from medloom.operators.lineage import merge_first_seen
from medloom.sources.history import History

SCHEMA = "k string, city string, lineage_first_seen_ts string, lineage_last_updated_ts string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def existing(spark):
    return spark.createDataFrame([(str(k), "old", "2024-01-01", "2024-01-01") for k in range(2000)], SCHEMA)


def files(folder):
    return {p: p.stat().st_size for p in folder.glob("data/**/*.parquet")}


def test_equals_the_full_merge_and_writes_what_it_touches(spark, tmp_path, existing):
    history = History(spark, str(tmp_path / "h"), ["k"], buckets=64)
    assert history.version() is None and len(history.merge(existing)) == 64
    full, before = existing, files(tmp_path / "h")
    for turn, keys in enumerate((["5"], ["7", "new", None], [None, "5", "77", "new"])):
        moment = f"2024-0{turn + 2}-01"
        incoming = spark.createDataFrame([(k, "new", moment, moment) for k in keys], SCHEMA)
        touched = history.merge(incoming)
        assert 1 <= len(touched) <= len(keys)
        full = merge_first_seen(full, incoming, ["k"])
        assert rows(history.read()) == rows(full)
        added = {p: n for p, n in files(tmp_path / "h").items() if p not in before}
        assert len(added) == len(touched) and sum(added.values()) < sum(before.values()) / 10
        before |= added
    assert history.version() == 3
    first = {r.k: r.lineage_first_seen_ts for r in history.read().collect()}
    assert (first["5"], first["new"], first["77"]) == ("2024-01-01", "2024-03-01", "2024-01-01")


def test_keys_must_be_unique(spark, tmp_path, existing):
    history = History(spark, str(tmp_path / "h"), ["k"], buckets=8)
    history.merge(existing)
    with pytest.raises(ValueError, match="more than one"):
        history.merge(existing.limit(1).union(existing.limit(1)))
    assert history.version() == 0 and history.read().count() == 2000


def test_a_stopped_merge_leaves_the_version_before(spark, tmp_path, existing):
    history = History(spark, str(tmp_path / "h"), ["k"], buckets=8)
    history.merge(existing)
    incoming = spark.createDataFrame([("5", "new", "2024-02-01", "2024-02-01")], SCHEMA)
    history.merge(incoming)
    (tmp_path / "h" / "manifest" / "version=1" / "_SUCCESS").unlink()
    assert history.version() == 0 and rows(history.read()) == rows(existing)
    history.merge(incoming)
    assert rows(history.read()) == rows(merge_first_seen(existing, incoming, ["k"]))


def test_nothing_incoming(spark, tmp_path, existing):
    history = History(spark, str(tmp_path / "h"), ["k"], buckets=8)
    history.merge(existing)
    assert history.merge(existing.limit(0)) == [] and rows(history.read()) == rows(existing)
