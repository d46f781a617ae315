"""Data-quality checks.

Every check returns rows ``check, subject, violations, total, passed``.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.operators.joins import distinct_ids, fhir_omop_birth_join
from medloom.schemas import AGE_PROFILE, CORE_DIAGNOSIS_CONCEPTS

RESULT_SCHEMA = "check string, subject string, violations bigint, total bigint, passed boolean"

Contract = Mapping[str, tuple[str, tuple[str, ...]]]


def _rows() -> Column:
    return F.count(F.lit(1))


def _result(check: str, subject: str, violations: Column, total: Column) -> Column:
    n = violations.cast("bigint")
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(subject).alias("subject"),
        n.alias("violations"),
        total.cast("bigint").alias("total"),
        (n == 0).alias("passed"),
    )


def _report(df: DataFrame, *results: Column) -> DataFrame:
    """Result rows from one aggregated row."""
    return df.select(F.inline(F.array(*results)))


def _one(df: DataFrame, check: str, subject: str, violations: Column) -> DataFrame:
    counted = df.agg(violations.alias("v"), _rows().alias("n"))
    return _report(counted, _result(check, subject, F.col("v"), F.col("n")))


def union_all(results: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


# --- column checks -------------------------------------------------------------------


def dq_unique(df: DataFrame, column: str, subject: str | None = None) -> DataFrame:
    """Values that occur more than once; nulls do not count."""
    keys = df.select(column).filter(F.col(column).isNotNull())
    counts = keys.groupBy(column).agg(_rows().alias("n"))
    totals = counts.agg(F.count_if(F.col("n") > 1).alias("v"), F.sum("n").alias("n"))
    total = F.coalesce("n", F.lit(0))
    return _report(totals, _result("unique", subject or column, F.col("v"), total))


def dq_not_null(df: DataFrame, *columns: str) -> DataFrame:
    """One pass for all columns."""
    counts = df.agg(
        _rows().alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return _report(counts, *[_result("not_null", c, F.col(c), F.col("_n")) for c in columns])


def dq_accepted_values(df: DataFrame, column: str, values: Collection[Any]) -> DataFrame:
    """Values outside the list; null passes."""
    return _one(df, "accepted_values", column, F.count_if(~F.col(column).isin(*values)))


def dq_expected_codes(df: DataFrame, column: str, codes: Collection[Any]) -> DataFrame:
    """Distinct unexpected codes among the distinct codes."""
    found = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return _one(found, "expected_codes", column, F.count_if(~F.col(column).isin(*codes)))


def dq_required_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Without the column every row is a violation."""
    n = F.col("n")
    results = [
        _result("required_columns", c, F.lit(0) if c in df.columns else n, n) for c in columns
    ]
    return _report(df.agg(_rows().alias("n")), *results)


def dq_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Names, types and constraints of a contract.

    Missing, unexpected and wrongly typed columns come from the schema alone; all null
    constraints take one pass, each unique constraint one grouped count.
    """
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    rows = []
    for name, (type_, _) in contract.items():
        rows.append(("contract_column", name, int(name not in have), 1, name in have))
        if name in have:
            same = have[name] == type_
            rows.append(("contract_type", name, int(not same), 1, same))
    rows += [("contract_extra_column", n, 1, 1, False) for n in have if n not in contract]
    results = [df.sparkSession.createDataFrame(rows, RESULT_SCHEMA)]
    constrained = {n: rules for n, (_, rules) in contract.items() if n in have}
    required = [n for n, rules in constrained.items() if "not_null" in rules]
    if required:
        results.append(dq_not_null(df, *required))
    results += [dq_unique(df, n) for n, rules in constrained.items() if "unique" in rules]
    return union_all(results)


# --- configured checks ---------------------------------------------------------------


def dq_domain_range(
    frames: Mapping[str, DataFrame], domains: Mapping[str, Sequence[Mapping[str, Any]]]
) -> DataFrame:
    """Range constraints on OMOP tables; one pass per table.

    A missing table or column is itself a violation; other models are skipped; null passes.
    """
    by_table: dict[str, list[Mapping[str, Any]]] = {}
    for constraints in domains.values():
        for c in constraints:
            model, _, table = c["model"].partition(".")
            if model == "omop":
                by_table.setdefault(table, []).append(c)
    absent: list[tuple] = []
    results: list[DataFrame] = []
    spark: SparkSession = next(iter(frames.values())).sparkSession
    for table, constraints in by_table.items():
        df = frames.get(table)
        usable = []
        for c in constraints:
            if df is None:
                absent.append(("table_found", f"{c['id']}:{table}", 1, 1, False))
            elif c["field"] not in df.columns:
                absent.append(("field_found", f"{c['id']}:{c['field']}", 1, 1, False))
            elif c["type"] == "range":
                usable.append(c)
        if df is not None and usable:
            tests = {
                c["id"]: (F.col(c["field"]) < c["min"]) | (F.col(c["field"]) > c["max"])
                for c in usable
            }
            counts = df.agg(
                _rows().alias("_n"), *[F.count_if(t).alias(i) for i, t in tests.items()]
            )
            results.append(
                _report(counts, *[_result("range", i, F.col(f"`{i}`"), F.col("_n")) for i in tests])
            )
    if absent or not results:
        results.append(spark.createDataFrame(absent, RESULT_SCHEMA))
    return union_all(results)


def dq_terminology(
    df: DataFrame, column: str, concept_set: Collection[int] = CORE_DIAGNOSIS_CONCEPTS
) -> DataFrame:
    """Rows whose concept is not in the concept set."""
    return _one(df, "terminology", column, F.count_if(~F.col(column).isin(*concept_set)))


def dq_distribution(
    df: DataFrame, column: str, profile: Mapping[str, float] = AGE_PROFILE, tolerance: float = 0.2
) -> DataFrame:
    """Mean and deviation within ``tolerance`` (relative) of a profile, values in bounds."""
    c = F.col(column)
    stats = df.agg(
        F.count(c).alias("n"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("stddev"),
        F.count_if((c < profile["min"]) | (c > profile["max"])).alias("outside"),
    )

    def off(name: str) -> Column:
        far = F.abs(F.col(name) - profile[name]) > tolerance * profile[name]
        return F.when(F.coalesce(far, F.lit(True)), 1).otherwise(0)

    return _report(
        stats,
        _result("distribution_mean", column, off("mean"), F.col("n")),
        _result("distribution_stddev", column, off("stddev"), F.col("n")),
        _result("distribution_bounds", column, F.col("outside"), F.col("n")),
    )


def distribution_summary(df: DataFrame, column: str, profile: Mapping[str, float] = AGE_PROFILE) -> DataFrame:
    c = F.col(column)
    return df.agg(
        F.count(c).alias("n"),
        F.round(F.avg(c), 4).alias("mean"),
        F.round(F.stddev_samp(c), 4).alias("stddev"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
        F.count_if((c < profile["min"]) | (c > profile["max"])).alias("outside"),
    )


def dq_anomaly_share(
    df: DataFrame, name: str, predicate: Column, max_share: float = 0.01
) -> DataFrame:
    """Rows meeting the predicate; passes while their share stays within the bound."""
    counts = df.agg(F.count_if(predicate).alias("v"), _rows().alias("n"))
    return counts.select(
        F.lit("anomaly_share").alias("check"),
        F.lit(name).alias("subject"),
        F.col("v").alias("violations"),
        F.col("n").alias("total"),
        (F.col("v") <= F.col("n") * max_share).alias("passed"),
    )


def dq_freshness(df: DataFrame, ts: str, now: str, max_age_days: int = 7) -> DataFrame:
    """The newest row is not older than the limit; an empty frame is not fresh."""
    oldest = F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(F.lit(max_age_days))
    newest = F.max(F.col(ts).cast("timestamp_ntz"))
    stale = F.when(F.coalesce(newest < oldest, F.lit(True)), 1).otherwise(0)
    return _one(df, "freshness", ts, stale)


# --- checks across frames ------------------------------------------------------------


def dq_referential_integrity(
    frames: Mapping[str, DataFrame], relations: Sequence[tuple[str, str, str, str]]
) -> DataFrame:
    """Orphans per relation ``(fact, fk, dim, pk)``; null references do not count.

    Keys are compared as text. A fact is read and shuffled once for all of its relations, as counts
    per key, so a hot key joins as one row.
    """
    results = []
    for fact in dict.fromkeys(r[0] for r in relations):
        own = list(enumerate(r[1:] for r in relations if r[0] == fact))

        def keyed(number: int, column: str) -> Column:
            return F.struct(F.lit(number).alias("relation"), F.col(column).cast("string").alias("key"))

        keys = frames[fact].select(F.inline(F.array(*[keyed(k, fk) for k, (fk, _, _) in own])))
        known = [frames[dim].select(keyed(k, pk).alias("r")).select("r.*") for k, (_, dim, pk) in own]
        known = reduce(DataFrame.unionAll, known).distinct().withColumn("known", F.lit(1))
        counted = keys.groupBy("relation", "key").agg(_rows().alias("n"))
        orphan = F.col("key").isNotNull() & F.col("known").isNull()
        sums = []
        for k, _ in own:
            mine = F.col("relation") == k
            sums.append(F.coalesce(F.sum(F.when(mine & orphan, F.col("n"))), F.lit(0)).alias(f"v{k}"))
            sums.append(F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0)).alias(f"n{k}"))
        counts = counted.join(known, ["relation", "key"], "left").agg(*sums)
        checks = [
            _result("referential_integrity", f"{fact}.{fk}->{dim}.{pk}", F.col(f"v{k}"), F.col(f"n{k}"))
            for k, (fk, dim, pk) in own
        ]
        results.append(_report(counts, *checks))
    return union_all(results)


def dq_row_count_match(a: DataFrame, b: DataFrame, subject: str) -> DataFrame:
    other = b.agg(_rows()).scalar()
    counts = a.agg(_rows().alias("n")).withColumn("v", F.abs(F.col("n") - other))
    return _report(counts, _result("row_count_match", subject, F.col("v"), F.col("n")))


def _id_overlap(person: DataFrame, flat_patient: DataFrame) -> DataFrame:
    """One row with the sizes of both id sets and of what each side lacks; one join."""
    omop, fhir = distinct_ids(person, flat_patient)
    sides = omop.withColumn("omop", F.lit(1)).join(
        fhir.withColumn("fhir", F.lit(1)), "person_id", "full_outer"
    )
    return sides.agg(
        F.count_if(F.col("fhir").isNull()).alias("missing_in_fhir"),
        F.count_if(F.col("omop").isNull()).alias("missing_in_omop"),
        F.count("omop").alias("omop_persons"),
        F.count("fhir").alias("fhir_patients"),
    )


def _id_results() -> list[Column]:
    sides = {"missing_in_fhir": "omop_persons", "missing_in_omop": "fhir_patients"}
    return [_result("cross_model_ids", s, F.col(s), F.col(n)) for s, n in sides.items()]


def _pair_counts(person: DataFrame, flat_patient: DataFrame) -> DataFrame:
    """One row with the matched pairs and those with another (or unreadable) birth date."""
    date = F.col("birth_date").try_cast("date")
    parts = {"year_of_birth": F.year, "month_of_birth": F.month, "day_of_birth": F.dayofmonth}
    same = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(part(date)) for c, part in parts.items()]
    )
    return fhir_omop_birth_join(person, flat_patient).agg(
        F.count_if(F.col("birth_date").isNotNull() & ~same).alias("wrong"),
        _rows().alias("matched_records"),
    )


def _birthdate_result() -> Column:
    return _result(
        "cross_model_birthdate", "birth_date", F.col("wrong"), F.col("matched_records")
    )


def _size(name: str) -> Column:
    return _result("cross_model_size", name, F.lit(0), F.col(name))


def dq_cross_model_ids(person: DataFrame, flat_patient: DataFrame) -> DataFrame:
    """Ids that one model has and the other lacks."""
    return _report(_id_overlap(person, flat_patient), *_id_results())


def dq_cross_model_birthdate(person: DataFrame, flat_patient: DataFrame) -> DataFrame:
    """Matched pairs with another birth date; no FHIR date is no mismatch, no OMOP part is."""
    return _report(_pair_counts(person, flat_patient), _birthdate_result())


def cross_model_report(person: DataFrame, flat_patient: DataFrame) -> DataFrame:
    """All cross-model checks plus the sizes of both models and of the match."""
    ids = _report(
        _id_overlap(person, flat_patient),
        *_id_results(),
        _size("omop_persons"),
        _size("fhir_patients"),
    )
    pairs = _report(
        _pair_counts(person, flat_patient), _birthdate_result(), _size("matched_records")
    )
    return ids.unionByName(pairs)


def dq_gender_consistency(person: DataFrame, flat_patient: DataFrame) -> DataFrame:
    """male is 8507 and female is 8532 in matched rows; other genders are not compared."""
    expected = F.when(F.col("gender") == "male", 8507).when(F.col("gender") == "female", 8532)
    pairs = person.select("person_id", "gender_concept_id").join(
        flat_patient.select(F.col("person_id_omop").alias("person_id"), "gender"), "person_id"
    )
    wrong = expected.isNotNull() & ~F.col("gender_concept_id").eqNullSafe(expected)
    return _one(pairs, "gender_consistency", "gender", F.count_if(wrong))


# --- runs and outputs ----------------------------------------------------------------


def slo_success_rate(run_log: DataFrame, target: float = 0.99) -> DataFrame:
    """Share of successful runs per month against the target."""
    month = F.date_trunc("month", F.col("started_at")).cast("date").alias("month")
    rate = F.count_if(F.col("status") == "success") / _rows()
    monthly = run_log.groupBy(month).agg(
        _rows().alias("runs"), F.round(rate, 6).alias("success_rate")
    )
    return monthly.withColumn("met", F.col("success_rate") >= target)


def slo_duration(run_log: DataFrame, limit_minutes: float = 20) -> DataFrame:
    """Runs per month that took the limit or longer."""
    month = F.date_trunc("month", F.col("started_at")).cast("date").alias("month")
    seconds = F.unix_micros(F.col("ended_at").cast("timestamp")) - F.unix_micros(
        F.col("started_at").cast("timestamp")
    )
    minutes = seconds / 60e6
    monthly = run_log.groupBy(month).agg(
        _rows().alias("runs"),
        F.count_if(minutes >= limit_minutes).alias("late_runs"),
        F.round(F.max(minutes), 4).alias("max_minutes"),
    )
    return monthly.withColumn("met", F.col("late_runs") == 0)


def expected_outputs(manifest: DataFrame, names: Sequence[str]) -> DataFrame:
    """Required outputs with their size; ``found`` is false when no file belongs to one."""
    spark = manifest.sparkSession
    wanted = spark.createDataFrame([(n,) for n in names], "output string")
    sizes = manifest.select(
        F.explode(
            F.array(
                *[
                    F.when(
                        F.concat("path", F.lit("/")).contains(f"/{n}/") & (F.col("length") > 0),
                        F.lit(n),
                    )
                    for n in names
                ]
            )
        ).alias("output"),
        "length",
    )
    totals = sizes.filter(F.col("output").isNotNull()).groupBy("output").agg(
        F.sum("length").alias("bytes"), _rows().alias("files")
    )
    return wanted.join(totals, "output", "left").select(
        "output",
        F.col("files").isNotNull().alias("found"),
        F.coalesce("files", F.lit(0)).alias("files"),
        F.coalesce("bytes", F.lit(0)).alias("bytes"),
    )


def dq_report(results: Sequence[DataFrame], run_id: str, target: str) -> DataFrame:
    """All results of one run, stored under its run id; a repeated run replaces itself."""
    report = union_all(results).withColumn("run_id", F.lit(run_id))
    report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "run_id"
    ).parquet(target)
    spark = report.sparkSession
    return spark.read.parquet(target).filter(F.col("run_id") == run_id)
