"""States that add up: metrics of days, sketches of groups, hashes of ranges."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from medloom.operators import drift, metrics


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(6)
    start = date(2023, 12, 20)
    rows = [
        (rng.randrange(-50, 70_000) if rng.random() < 0.9 else None, rng.choice("ab"), rng.randrange(100),
         str(start + timedelta(rng.randrange(60))) if rng.random() < 0.95 else None)
        for _ in range(4000)
    ]
    return spark.createDataFrame(rows, "person bigint, dim string, value int, day_text string").cache()


@pytest.mark.parametrize("kind", ["count", "sum", "average", "min", "max", "count_distinct"])
@pytest.mark.parametrize("dims, grain", [(["dim"], "month"), ([], None)])
def test_rolled_up_days_equal_the_full_run(spark, facts, tmp_path, kind, dims, grain):
    expr = "person" if kind == "count_distinct" else "value"
    spec = metrics.MetricSpec("m", "facts", kind, expr, "day_text", (("value", ">", "10"),))
    # Days arrive in three parts; each adds its states, none is read again.
    day = F.col("day_text")
    parts = [day < "2024-01-05", day >= "2024-01-05", day.isNull()]
    for k, part in enumerate(parts):
        metrics.metric_states(spec, facts.where(part), ["dim"]).write.parquet(str(tmp_path / str(k)))
    states = spark.read.parquet(str(tmp_path / "*"))
    found = metrics.roll_up(states, spec, dims, grain)
    want = metrics.calculate_metric(spec, {"facts": facts}, dims, grain)
    assert found.columns == want.columns and found.dtypes == want.dtypes
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_exact_sets_need_whole_numbers(facts):
    spec = metrics.MetricSpec("m", "facts", "count_distinct", "dim", "day_text")
    with pytest.raises(ValueError, match="whole numbers"):
        metrics.metric_states(spec, facts)


def test_merged_sketches_agree_with_exact_ranks(spark):
    rng = random.Random(8)
    values = [(rng.randrange(20), rng.gauss(55, 12)) for _ in range(20_000)] + [(99, None)]
    df = spark.createDataFrame(values, "day int, v double").repartition(7)
    days = drift.distribution_sketches(df, "v", ["day"])
    (row,) = drift.distribution_gap(drift.merge_sketches(days)).collect()
    known = sorted(v for _, v in values if v is not None)
    exact = max(abs(sum(v <= at for v in known) / len(known) - share) for at, share in drift.profile_points())
    assert row.n == 20_000 and abs(row.gap - exact) <= drift.rank_error()
    # The profile itself passes, the drifted one does not, a day without values neither.
    own = {"mean": 55.0, "stddev": 12.0, "min": 0.0, "max": 110.0}
    verdicts = {r.subject: r.passed for r in drift.dq_drift(days, F.col("day").cast("string"), 0.1, own).collect()}
    assert verdicts.pop("99") is False and all(verdicts.values()) and len(verdicts) == 20
    assert not drift.dq_drift(drift.merge_sketches(days), F.lit("all"), 0.05).first().passed


def test_hash_trees_lead_to_what_changed(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("v"))
    planted = {"17", "2200", "4999"}
    after = rows.withColumn("v", F.when(F.col("k").isin(*planted), 99).otherwise(F.col("v"))).where("k <> '55'")
    after = after.union(spark.createDataFrame([("new", 1)], "k string, v long"))
    columns, key = ["k", "v"], ["k"]
    a, b = (metrics.hash_tree(df, columns, key).cache() for df in (rows, after))
    ranges, compared = metrics.differing_ranges(a, b)
    # The whole, and at most sixteen parts of each range on the way to five rows.
    assert 3 <= len(ranges) <= 5 and compared <= 1 + 16 + 2 * 5 * 16
    read = metrics.in_ranges(after, key, ranges)
    assert read.count() < 40
    changed = read.exceptAll(metrics.in_ranges(rows, key, ranges))
    assert {r.k for r in changed.collect()} == planted | {"new"}
    assert metrics.differing_ranges(a, a) == ([], 1)
    assert metrics.in_ranges(rows, key, []).count() == 0
    whole = a.where("range = ''").first()
    assert (whole.row_count, whole.content_hash) == tuple(metrics.dataset_hash(rows, columns).first())
    empty = metrics.hash_tree(rows.limit(0), columns, key)
    assert empty.count() == 0 and metrics.differing_ranges(a, empty)[0]
