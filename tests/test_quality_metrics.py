import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from medloom.operators import joins, lineage, metrics, quality, sets
from medloom.schemas import DOMAIN_CONSTRAINTS

PERSON = "person_id bigint, gender_concept_id bigint, year_of_birth bigint, month_of_birth bigint, day_of_birth bigint"
FLAT = "person_id_omop bigint, birth_date string, gender string"


def _violations(df):
    return {(r.check, r.subject): r.violations for r in df.collect()}


def test_range_counts_one_of_three(spark):
    person = spark.createDataFrame([(1990,), (2020,), (1850,), (None,)], "year_of_birth bigint")
    (row,) = quality.dq_domain_range({"person": person}, DOMAIN_CONSTRAINTS).collect()
    assert (row.subject, row.violations, row.total, row.passed) == ("patient_age_range", 1, 4, False)


def test_matching_models_pass(spark):
    person = spark.createDataFrame([(i, 8507, 1980, 1, i) for i in (1, 2, 3)], PERSON)
    flat = spark.createDataFrame([(i, f"1980-01-0{i}", "male") for i in (1, 2, 3)], FLAT)
    assert all(r.passed for r in quality.cross_model_report(person, flat).collect())
    assert quality.dq_gender_consistency(person, flat).first().passed


def test_cross_model_edge_rows(spark):
    person = spark.createDataFrame(
        [(1, 8507, 1980, None, 1), (2, 8507, 1980, 1, 1), (3, 0, 1980, 1, 1), (9, 0, 1, 1, 1)], PERSON
    )
    flat = spark.createDataFrame(
        [
            (1, "1980-01-01", "male"),
            (2, None, "female"),
            (3, "1980-01-02", "other"),
            (None, "x", "male"),
            (7, None, None),
            (7, None, None),
        ],
        FLAT,
    )
    got = _violations(quality.cross_model_report(person, flat.filter("birth_date <> 'x' OR birth_date IS NULL")))
    assert got[("cross_model_birthdate", "birth_date")] == 2
    assert got[("cross_model_ids", "missing_in_fhir")] == 1
    assert got[("cross_model_ids", "missing_in_omop")] == 1
    assert quality.dq_gender_consistency(person, flat).first().violations == 1


def test_unreadable_birth_date_is_a_mismatch(spark):
    person = spark.createDataFrame([(1, 0, 1980, 1, 1), (2, 0, 1980, 5, 1)], PERSON)
    flat = spark.createDataFrame([(1, "not a date", "male"), (2, "1980-05", "male")], FLAT)
    assert quality.dq_cross_model_birthdate(person, flat).first().violations == 1


def test_null_rules(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert _violations(quality.dq_unique(df, "k")) == {("unique", "k"): 1}
    assert _violations(quality.dq_not_null(df, "k")) == {("not_null", "k"): 2}
    assert _violations(quality.dq_accepted_values(df, "k", ["a"])) == {("accepted_values", "k"): 1}
    empty = df.limit(0)
    assert quality.dq_unique(empty, "k").first().passed
    assert not quality.dq_freshness(empty.withColumn("t", F.current_timestamp()), "t", "2025-01-01").first().passed


def test_contract(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "a bigint, b string")
    contract = {"a": ("string", ("unique",)), "b": ("string", ("not_null",)), "c": ("date", ("not_null",))}
    got = {k for k, v in _violations(quality.dq_contract(df.withColumn("d", F.lit(1)), contract)).items() if v}
    assert got == {
        ("contract_type", "a"), ("unique", "a"), ("not_null", "b"),
        ("contract_column", "c"), ("contract_extra_column", "d"),
    }


def test_hot_key_references(spark):
    """A third of the facts point to one key, some to a missing one, some nowhere."""
    n = 3000
    keys = ["hot"] * (n // 3) + [f"k{i}" for i in range(n // 3)] + ["gone"] * 7 + [None] * 50
    fact = spark.createDataFrame([(k,) for k in keys], "fk string")
    dim = spark.createDataFrame([("hot",), ("hot",)] + [(f"k{i}",) for i in range(n // 3)], "pk string")
    result = quality.dq_referential_integrity({"f": fact, "d": dim}, [("f", "fk", "d", "pk")])
    assert (result.first().violations, result.first().total) == (7, len(keys))
    assert joins.orphan_records(fact, dim, "fk", "pk").count() == 7


def test_anomaly_and_distribution(spark):
    df = spark.createDataFrame([(float(a),) for a in [20, 35, 50, 65, 80]], "age double")
    got = _violations(quality.dq_distribution(df, "age", tolerance=0.6))
    assert set(got.values()) == {0}
    assert not quality.dq_anomaly_share(df, "old", F.col("age") >= 80, 0.1).first().passed
    assert quality.dq_anomaly_share(df, "old", F.col("age") >= 80, 0.2).first().passed


def test_report_of_a_run_replaces_itself(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "k string")
    checks = [quality.dq_not_null(df, "k"), quality.dq_unique(df, "k")]
    for run in ("r1", "r2", "r1"):
        assert quality.dq_report(checks, run, str(tmp_path / "dq")).count() == 2
    assert spark.read.parquet(str(tmp_path / "dq")).count() == 4


def test_statistics_against_brute_force(spark):
    rng = random.Random(3)
    persons = list(range(40))
    rows = [(rng.choice([1] * 20 + persons), rng.choice([201826, 320128, 317009, 5])) for _ in range(600)]
    condition = spark.createDataFrame(rows, "person_id bigint, condition_concept_id bigint")
    person = spark.createDataFrame([(p,) for p in persons], "person_id bigint")
    per_concept, per_person = defaultdict(set), defaultdict(set)
    for p, c in rows:
        per_concept[c].add(p)
        per_person[p].add(c)
    got = {r.condition_concept_id: r for r in metrics.condition_prevalence(condition, person).collect()}
    assert {c: r.patient_count for c, r in got.items()} == {c: len(s) for c, s in per_concept.items()}
    assert all(r.prevalence_pct == round(r.patient_count * 100 / 40, 2) for r in got.values())
    histogram = {r.num_conditions: r.patient_count for r in metrics.comorbidity_histogram(condition).collect()}
    assert histogram == Counter(len(s) for s in per_person.values())


def test_gender_labels_keep_unknown_ids_apart(spark):
    df = spark.createDataFrame([(8507,), (8532,), (0,), (1,)], "gender_concept_id bigint")
    rows = metrics.gender_distribution(df).collect()
    assert Counter(r.gender for r in rows) == {"Male": 1, "Female": 1, "Unknown": 2}
    assert all(r.percentage == 25.0 for r in rows)


def test_empty_slices(spark):
    dim = spark.createDataFrame([(1, "male")], "person_id bigint, gender string")
    fact = spark.createDataFrame([], "person_id bigint, condition_concept_id bigint, is_chronic boolean")
    assert metrics.metric_prevalence(fact, dim, ["gender"]).first().prevalence == 0.0
    assert metrics.metric_prevalence(fact, dim.limit(0)).first().prevalence is None
    assert metrics.metric_diagnosis_rate(fact).first().diagnosis_rate is None


def test_calculate_metric_rejects_unknown_parts(spark):
    df = spark.createDataFrame([(1,)], "a bigint")
    for spec in (
        metrics.MetricSpec("m", "t", "median", "a"),
        metrics.MetricSpec("m", "t", "count", "a", filters=(("a", "~", "1"),)),
    ):
        with pytest.raises(ValueError):
            metrics.calculate_metric(spec, {"t": df})
    with pytest.raises(ValueError):
        metrics.calculate_metric(metrics.MetricSpec("m", "t", "count", "a"), {"t": df}, grain="month")


def test_hash_ignores_order_and_partitions_but_not_content(spark):
    df = spark.range(100).select("id", (F.col("id") * 2).alias("b"))
    first = metrics.dataset_hash(df, ["id", "b"]).first()
    assert metrics.dataset_hash(df.orderBy(F.desc("id")).repartition(5), ["id", "b"]).first() == first
    changed = df.withColumn("b", F.when(F.col("id") == 50, 0).otherwise(F.col("b")))
    assert metrics.dataset_hash(changed, ["id", "b"]).first() != first
    assert metrics.dataset_hash(df.union(df.limit(1)).union(df.limit(1)), ["id", "b"]).first() != first


def test_sets(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(2,), (None,)], "x int")
    assert [r.x for r in sets.set_difference(a, b, ["x"]).collect()] == [1]
    assert sets.disjoint_ids(a.filter("x = 1"), b, "x").first().disjoint
    assert not sets.disjoint_ids(a, b, "x").first().disjoint


def _stamped(spark, rows):
    schema = "k string, v string, lineage_last_updated_ts timestamp_ntz, lineage_first_seen_ts timestamp_ntz"
    return spark.createDataFrame([(k, v, dt.datetime(2024, 1, d), dt.datetime(2024, 1, d)) for k, v, d in rows], schema)


def test_merge_first_seen(spark):
    old = _stamped(spark, [("a", "1", 1), ("b", "1", 5), ("c", "1", 1)])
    new = _stamped(spark, [("a", None, 3), ("b", "2", 2), ("d", "2", 3)])
    rows = {r.k: r for r in lineage.merge_first_seen(old, new, ["k"]).collect()}
    assert {k: (r.v, r.lineage_first_seen_ts.day, r.lineage_last_updated_ts.day) for k, r in rows.items()} == {
        "a": (None, 1, 3), "b": ("2", 2, 2), "c": ("1", 1, 1), "d": ("2", 3, 3),
    }


def test_expected_outputs(spark):
    manifest = spark.createDataFrame(
        [("file:/x/person.parquet/part-0", 10), ("file:/x/person.parquet/_SUCCESS", 0), ("file:/x/empty.parquet", 0)],
        "path string, length bigint",
    )
    names = ["person.parquet", "empty.parquet", "none.parquet"]
    got = {r.output: (r.found, r.files, r.bytes) for r in quality.expected_outputs(manifest, names).collect()}
    assert got == {"person.parquet": (True, 1, 10), "empty.parquet": (False, 0, 0), "none.parquet": (False, 0, 0)}


def test_hash_tells_cells_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "1:a"), ("", None), ("-", ""), ("1:a", None)]
    hashes = {
        metrics.dataset_hash(spark.createDataFrame([r], "x string, y string"), ["x", "y"]).first().content_hash for r in rows
    }
    assert len(hashes) == len(rows)


def test_expected_outputs_are_whole_names(spark):
    paths = [("/o/person.parquet_old/part-0", 5), ("/o/condition.parquet/part-0", 7), ("/o/visit.parquet", 3)]
    manifest = spark.createDataFrame(paths, "path string, length bigint")
    found = quality.expected_outputs(manifest, ["person.parquet", "condition.parquet", "visit.parquet"]).collect()
    assert {r.output: r.found for r in found} == {"person.parquet": False, "condition.parquet": True, "visit.parquet": True}
