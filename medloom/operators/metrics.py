"""Cohort statistics and metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.functions.concepts import named
from medloom.functions.documents import path
from medloom.schemas import CONDITION_NAMES, GENDER_CONCEPTS, MEASUREMENT_NAMES


def _rows() -> Column:
    return F.count(F.lit(1))


# --- ordering and shares -------------------------------------------------------------


def top_n(df: DataFrame, key: str, n: int, *tie_break: str) -> DataFrame:
    return df.orderBy(F.col(key).desc(), *[F.col(c).asc() for c in tie_break]).limit(n)


def top_20(df: DataFrame, key: str, *tie_break: str) -> DataFrame:
    return top_n(df, key, 20, *tie_break)


def order_asc(df: DataFrame, *keys: str) -> DataFrame:
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys])


def pct_of_total(df: DataFrame, count: str, name: str = "percentage", digits: int = 2) -> DataFrame:
    """Share of each row in the sum of all rows.

    The sum is a scalar subquery, so no window gathers the rows in one task.
    """
    total = df.agg(F.sum(count)).scalar()
    return df.withColumn(name, F.round(F.col(count) * 100.0 / total, digits))


# --- cohort statistics ---------------------------------------------------------------


def patient_total(person: DataFrame) -> DataFrame:
    return person.agg(_rows().alias("total_patients"))


def gender_distribution(person: DataFrame) -> DataFrame:
    """One row per concept id, so several unknown ids give several ``Unknown`` rows."""
    counts = person.groupBy("gender_concept_id").agg(_rows().alias("count"))
    labelled = counts.withColumn(
        "gender", named("gender_concept_id", GENDER_CONCEPTS, "Unknown")
    )
    return pct_of_total(labelled, "count").select("gender", "count", "percentage")


def age_decade_histogram(person: DataFrame, as_of: str) -> DataFrame:
    age = F.year(F.lit(as_of).cast("date")) - F.col("year_of_birth")
    decade = (F.floor(age / 10) * 10).cast("bigint")
    counts = person.groupBy(decade.alias("age_decade")).agg(_rows().alias("count"))
    return order_asc(counts, "age_decade")


def condition_prevalence(condition: DataFrame, person: DataFrame) -> DataFrame:
    persons = person.agg(_rows()).scalar()
    counts = condition.groupBy("condition_concept_id").agg(
        F.countDistinct("person_id").alias("patient_count")
    )
    return counts.select(
        "condition_concept_id",
        named("condition_concept_id", CONDITION_NAMES, "Other").alias("condition_name"),
        "patient_count",
        F.round(F.col("patient_count") * 100.0 / persons, 2).alias("prevalence_pct"),
    ).orderBy(F.col("patient_count").desc(), "condition_concept_id")


def measurement_stats(measurement: DataFrame) -> DataFrame:
    value = F.col("value_as_number")
    stats = measurement.groupBy("measurement_concept_id").agg(
        _rows().alias("measurement_count"),
        F.round(F.avg(value), 2).alias("avg_value"),
        F.round(F.min(value), 2).alias("min_value"),
        F.round(F.max(value), 2).alias("max_value"),
    )
    return stats.withColumn(
        "measurement_name", named("measurement_concept_id", MEASUREMENT_NAMES, "Other")
    ).orderBy(F.col("measurement_count").desc(), "measurement_concept_id")


def comorbidity_histogram(condition: DataFrame) -> DataFrame:
    """Persons by their number of different conditions; persons without any do not appear."""
    per_person = (
        condition.select("person_id", "condition_concept_id")
        .distinct()
        .groupBy("person_id")
        .agg(F.count("condition_concept_id").alias("num_conditions"))
    )
    counts = per_person.groupBy("num_conditions").agg(_rows().alias("patient_count"))
    return order_asc(counts, "num_conditions")


def condition_counts(condition: DataFrame, *by: str) -> DataFrame:
    """Records per concept, person, name ..."""
    return condition.groupBy(*(by or ("condition_concept_id",))).agg(
        _rows().alias("condition_count")
    )


def deceased_rate(raw_patients: DataFrame) -> DataFrame:
    dead = F.count_if(path(".deceasedDateTime", "variant").isNotNull())
    return raw_patients.agg(
        _rows().alias("patients"),
        dead.alias("deceased"),
        F.round(dead * 100.0 / F.nullif(_rows(), F.lit(0)), 1).alias("deceased_pct"),
    )


def dataset_statistics(
    raw_patients: DataFrame, person: DataFrame, condition: DataFrame, measurement: DataFrame
) -> DataFrame:
    """One report ``section, statistic, value, pct``; one pass over each input."""

    def share(n: Column) -> Column:
        return F.round(n * 100.0 / F.nullif(F.col("n"), F.lit(0)), 1)

    def report(df: DataFrame, *rows: tuple[str, str, Column, Column | None]) -> DataFrame:
        lines = [
            F.struct(
                F.lit(section).alias("section"),
                F.lit(statistic).alias("statistic"),
                value.cast("bigint").alias("value"),
                (pct if pct is not None else F.lit(None)).cast("double").alias("pct"),
            )
            for section, statistic, value, pct in rows
        ]
        return df.select(F.inline(F.array(*lines)))

    patients = raw_patients.agg(
        _rows().alias("n"),
        F.count_if(path(".deceasedDateTime", "variant").isNotNull()).alias("dead"),
    )
    gender = {label.lower(): F.col("gender_concept_id") == c for c, label in GENDER_CONCEPTS.items()}
    persons = person.agg(
        _rows().alias("n"),
        *[F.count_if(test).alias(label) for label, test in gender.items()],
        F.min("year_of_birth").alias("first_year"),
        F.max("year_of_birth").alias("last_year"),
    )

    def per_concept(df: DataFrame, column: str, names: Mapping[int, str]) -> DataFrame:
        return df.agg(
            _rows().alias("n"),
            *[F.count_if(F.col(column) == c).alias(f"c{c}") for c in names],
        )

    def concept_rows(section: str, names: Mapping[int, str]):
        return [(section, name, F.col(f"c{c}"), None) for c, name in names.items()]

    n = F.col("n")
    return (
        report(
            patients,
            ("records", "fhir_patients", n, None),
            ("demographics", "deceased", F.col("dead"), share(F.col("dead"))),
        )
        .union(
            report(
                persons,
                ("records", "omop_persons", n, None),
                *[("demographics", g, F.col(g), share(F.col(g))) for g in gender],
                ("demographics", "birth_year_min", F.col("first_year"), None),
                ("demographics", "birth_year_max", F.col("last_year"), None),
            )
        )
        .union(
            report(
                per_concept(condition, "condition_concept_id", CONDITION_NAMES),
                ("records", "conditions", n, None),
                *concept_rows("conditions", CONDITION_NAMES),
            )
        )
        .union(
            report(
                per_concept(measurement, "measurement_concept_id", MEASUREMENT_NAMES),
                ("records", "measurements", n, None),
                *concept_rows("measurements", MEASUREMENT_NAMES),
            )
        )
    )


# --- metrics over the dimensional models ---------------------------------------------


def metric_patient_count(dim_patient: DataFrame) -> DataFrame:
    return dim_patient.agg(F.countDistinct("person_id").alias("patient_count"))


def _chronic(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("is_chronic"))


def metric_condition_patients(fact: DataFrame) -> DataFrame:
    return _chronic(fact).agg(
        F.countDistinct("person_id").alias("chronic_condition_patient_count")
    )


def metric_prevalence(
    fact: DataFrame, dim_patient: DataFrame, by: Sequence[str] = (), code: int | None = None
) -> DataFrame:
    """Chronic patients / all patients, per slice of the patient dimension."""
    chronic = _chronic(fact)
    if code is not None:
        chronic = chronic.filter(F.col("condition_concept_id") == code)
    ill = chronic.select("person_id").distinct().withColumn("ill", F.lit(1))
    patients = dim_patient.select("person_id", *by).distinct().join(ill, "person_id", "left")
    # Each person appears once per slice by now, so plain counts are distinct counts.
    counts = patients.groupBy(*by).agg(
        _rows().alias("patients"), F.count("ill").alias("condition_patients")
    )
    rate = F.round(F.try_divide("condition_patients", "patients"), 6)
    return counts.withColumn("prevalence", rate)


def metric_diagnosis_rate(fact: DataFrame) -> DataFrame:
    counts = _chronic(fact).agg(_rows().alias("n"), F.countDistinct("person_id").alias("p"))
    rate = F.round(F.try_divide("n", "p"), 6)
    return counts.select(rate.alias("diagnosis_rate"))


def metric_condition_count(fact: DataFrame) -> DataFrame:
    counts = _chronic(fact).groupBy("person_id").agg(
        F.count("condition_concept_id").alias("chronic_condition_count")
    )
    return counts.orderBy(F.col("chronic_condition_count").desc(), "person_id")


def metric_age_at_first_condition(fact: DataFrame, dim_patient: DataFrame) -> DataFrame:
    """Calendar-year age; a condition before birth gives a negative value and is kept."""
    first = _chronic(fact).groupBy("person_id").agg(F.min("condition_start_date").alias("first"))
    born = dim_patient.select("person_id", "year_of_birth")
    age = F.year(F.col("first").try_cast("date")) - F.col("year_of_birth")
    return first.join(born, "person_id").select(
        "person_id", age.cast("bigint").alias("age_at_first_condition")
    )


@dataclass(frozen=True)
class MetricSpec:
    """A metric over one model, as it stands in a metrics file."""

    name: str
    model: str
    type: str
    expr: str
    timestamp: str | None = None
    filters: tuple[tuple[str, str, str], ...] = ()  # (field, operator, value)


_AGGREGATES = {
    "count": F.count,
    "count_distinct": F.countDistinct,
    "sum": F.sum,
    "average": F.avg,
    "min": F.min,
    "max": F.max,
}
_OPERATORS = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
}


def _chosen(spec: MetricSpec, df: DataFrame) -> DataFrame:
    """The rows that a metric is about."""
    if spec.type not in _AGGREGATES:
        raise ValueError(f"unknown metric type {spec.type}")
    for field, operator, value in spec.filters:
        if operator not in _OPERATORS:
            raise ValueError(f"unknown operator {operator}")
        typed = F.lit(value).cast(df.schema[field].dataType)
        df = df.filter(_OPERATORS[operator](F.col(field), typed))
    return df


def _day(spec: MetricSpec) -> Column:
    if not spec.timestamp:
        raise ValueError(f"metric {spec.name} has no timestamp")
    return F.col(spec.timestamp).try_cast("timestamp_ntz")


def calculate_metric(
    spec: MetricSpec,
    models: Mapping[str, DataFrame],
    dims: Sequence[str] = (),
    grain: str | None = None,
) -> DataFrame:
    """Group a model by dimensions and a time grain; column named like the metric."""
    df = _chosen(spec, models[spec.model])
    keys: list[Column] = [F.col(d) for d in dims]
    if grain:
        keys.append(F.date_trunc(grain, _day(spec)).cast("date").alias(f"date_{grain}"))
    return df.groupBy(*keys).agg(_AGGREGATES[spec.type](F.expr(spec.expr)).alias(spec.name))


# What a day keeps of each type of metric, and how days add up.
_STATES = {
    "count": {"n": (F.count, F.sum)},
    "sum": {"total": (F.sum, F.sum)},
    "average": {"total": (F.sum, F.sum), "n": (F.count, F.sum)},
    "min": {"least": (F.min, F.min)},
    "max": {"most": (F.max, F.max)},
    "count_distinct": {
        "members": (lambda c: F.bitmap_construct_agg(F.bitmap_bit_position(c)), F.bitmap_or_agg)
    },
}


def metric_states(spec: MetricSpec, df: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    """States of a metric by dimensions and ``day``, from the rows of any days.

    States of further days are added to those kept, and ``roll_up`` gives the metric over all of them
    without reading the rows again. Distinct counts keep exact sets: a bitmap for each range of
    32,768 whole numbers. Rows without a time of their own have a null day.
    """
    chosen = _chosen(spec, df)
    value = F.expr(spec.expr)
    keys = [*[F.col(d) for d in dims], _day(spec).cast("date").alias("day")]
    if spec.type == "count_distinct":
        kind = chosen.select(value.alias("v")).schema["v"].dataType
        if not isinstance(kind, T.IntegralType):
            raise ValueError("exact sets are kept of whole numbers")
        keys.append(F.bitmap_bucket_number(value).alias("range"))
        chosen = chosen.where(value.isNotNull())
    return chosen.groupBy(*keys).agg(*[make(value).alias(s) for s, (make, _) in _STATES[spec.type].items()])


def roll_up(
    states: DataFrame, spec: MetricSpec, dims: Sequence[str] = (), grain: str | None = None
) -> DataFrame:
    """The metric over the days of ``states``, as ``calculate_metric`` gives it over their rows.

    ``dims`` may be some of those that the states were made with. A group whose values are all null
    has no distinct members and no row here.
    """
    keys = [F.col(d) for d in dims]
    if grain:
        keys.append(F.date_trunc(grain, F.col("day")).cast("date").alias(f"date_{grain}"))
    ranges = [F.col("range")] if spec.type == "count_distinct" else []
    named = [*dims, *([f"date_{grain}"] if grain else [])]
    merged = states.groupBy(*keys, *ranges).agg(*[add(s).alias(s) for s, (_, add) in _STATES[spec.type].items()])
    if spec.type == "count_distinct":
        merged = merged.groupBy(*named).agg(F.sum(F.bitmap_count("members")).alias("n"))
    result = F.try_divide(F.col("total").cast("double"), F.col("n")) if spec.type == "average" else F.col(merged.columns[-1])
    return merged.select(*named, result.alias(spec.name))


# --- content hash --------------------------------------------------------------------


def _row_text(columns: Sequence[str]) -> Column:
    """Each cell with its length before it, so that no two rows give one text; null has none."""
    text = [F.col(c).cast("string") for c in columns]
    cells = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]
    return F.concat(*cells)


def _row_hash(columns: Sequence[str]) -> Column:
    return F.conv(F.md5(_row_text(columns)).substr(1, 13), 16, 10).cast("decimal(20,0)")


def dataset_hash(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and an order-free content hash.

    Sums 52 bits of the md5 of each row, so equal rows add up instead of cancelling out and
    the result depends neither on row order nor on partitioning.
    """
    return df.agg(
        _rows().alias("row_count"),
        F.coalesce(F.sum(_row_hash(columns)), F.lit(0)).cast("string").alias("content_hash"),
    )


# --- hash tree -----------------------------------------------------------------------


def hash_tree(df: DataFrame, columns: Sequence[str], key: Sequence[str], levels: int = 3) -> DataFrame:
    """``range, row_count, content_hash``: the hash of each range of keys, and of ranges of ranges.

    A range is the first hex digits of the md5 of the key: none for the whole dataset, up to
    ``levels`` of them. Hashes are sums over rows, so a range's is the sum of its sixteen parts, and
    the whole's is that of ``dataset_hash`` over the same columns.
    """
    leaf = F.substring(F.md5(_row_text(key)), 1, levels)
    leaves = df.groupBy(leaf.alias("leaf")).agg(_rows().alias("n"), F.sum(_row_hash(columns)).alias("hash"))
    # From here on there are at most 16 ** levels rows.
    ranges = F.explode(F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda n: F.substring("leaf", F.lit(1), n)))
    return leaves.select(ranges.alias("range"), "n", "hash").groupBy("range").agg(
        F.sum("n").alias("row_count"), F.sum("hash").cast("string").alias("content_hash")
    )


def differing_ranges(a: DataFrame, b: DataFrame, levels: int = 3) -> tuple[list[str], int]:
    """The smallest ranges in which two hash trees differ, and how many ranges were compared.

    Goes down from the whole: the parts of a range that is equal on both sides are not looked at.
    """
    differing, compared = [""], 0
    for level in range(levels + 1):
        parts = [r + d for r in differing for d in "0123456789abcdef"] if level else [""]
        compared += len(parts)
        left, right = (
            t.where(F.col("range").isin(parts)).select("range", F.struct("row_count", "content_hash").alias(side))
            for t, side in ((a, "a"), (b, "b"))
        )
        both = left.join(right, "range", "full").where(~F.col("a").eqNullSafe(F.col("b")))
        differing = sorted(r["range"] for r in both.select("range").collect())
        if not differing:
            break
    return differing, compared


def in_ranges(df: DataFrame, key: Sequence[str], ranges: Sequence[str]) -> DataFrame:
    """The rows whose keys lie in some ranges of one length."""
    if not ranges:
        return df.where(F.lit(False))
    return df.where(F.substring(F.md5(_row_text(key)), 1, len(ranges[0])).isin(list(ranges)))
