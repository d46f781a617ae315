"""Searches over raw documents and over marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.functions.documents import path
from medloom.operators.bundles import to_searchset_bundle
from medloom.sources.substrings import SubstringIndex

MAX_COUNT = 1000
DEFAULT_COUNT = 100


class InvalidSearch(ValueError):
    """Search parameters that cannot be used."""


@dataclass(frozen=True)
class Page:
    count: int = DEFAULT_COUNT
    offset: int = 0

    @classmethod
    def of(cls, params: Mapping[str, str]) -> Page:
        try:
            count = min(int(params.get("_count", DEFAULT_COUNT)), MAX_COUNT)
            offset = int(params.get("_offset", 0))
        except ValueError:
            raise InvalidSearch("Invalid pagination parameters") from None
        if count < 0 or offset < 0:
            raise InvalidSearch("Invalid pagination parameters")
        return cls(count, offset)


def paginate(df: DataFrame, page: Page, order: Sequence[Column]) -> DataFrame:
    """One page; ``order`` must end in a unique key, or pages may overlap."""
    return df.orderBy(*order).offset(page.offset).limit(page.count)


def order_desc_page(df: DataFrame, key: str, id_: str, page: Page) -> DataFrame:
    """Newest first, unknown before all, ties by id."""
    return paginate(df, page, newest_first(key, id_))


def newest_first(key: str, id_: str) -> list[Column]:
    return [F.col(key).desc_nulls_first(), F.col(id_).asc()]


def get_by_id(raw: DataFrame, id_: str) -> DataFrame:
    return raw.filter(path(".id") == id_).limit(1)


# How a parameter is matched: parameter -> (document path, kind of match).
_ENCOUNTER_PARAMS = {
    "patient": (".subject.reference", "patient"),
    "status": (".status", "equal"),
    "date": (".period.start", "prefix"),
    "class": (".class.code", "equal"),
}
_OBSERVATION_PARAMS = {
    "patient": (".subject.reference", "patient"),
    "code": (".code.coding[0].code", "any"),
    "date": (".effectiveDateTime", "prefix"),
    "category": (".category[0].coding[0].code", "equal"),
    "status": (".status", "equal"),
}
_SORT_PATHS = {"encounter": ".period.start", "observation": ".effectiveDateTime"}
_PARAMS = {"encounter": _ENCOUNTER_PARAMS, "observation": _OBSERVATION_PARAMS}


def _codes(value: str) -> list[str]:
    return [c.strip() for c in value.split(",")]


def _like(pattern: str) -> str:
    return pattern.replace("\\", "\\\\")


def _predicate(expr: str, kind: str, value: str, exact_patient: bool) -> Column:
    column = path(expr)
    if kind == "patient":
        if exact_patient:
            return column == f"Patient/{value}"
        return column.like(_like(f"%Patient/{value}%"))
    if kind == "prefix":
        return column.like(_like(f"{value}%"))
    if kind == "any":
        return column.isin(*_codes(value))
    return column == value


def matching(
    raw: DataFrame, resource: str, params: Mapping[str, str], exact_patient: bool = False
) -> DataFrame:
    """Documents that meet all given parameters; an empty value counts as not given.

    The patient parameter matches as a part of the reference, so ``1`` also finds
    ``Patient/12``; ``exact_patient`` compares the whole reference.
    """
    found = raw
    for name, (expr, kind) in _PARAMS[resource].items():
        value = params.get(name)
        if value:
            found = found.filter(_predicate(expr, kind, value, exact_patient))
    return found


def search(
    raw: DataFrame, resource: str, params: Mapping[str, str], exact_patient: bool = False
) -> DataFrame:
    """One page of matching documents: ``id, sort_key, record_content``."""
    found = matching(raw, resource, params, exact_patient).select(
        path(".id").alias("id"),
        path(_SORT_PATHS[resource]).alias("sort_key"),
        "record_content",
    )
    return order_desc_page(found, "sort_key", "id", Page.of(params))


def search_encounters(
    raw: DataFrame, params: Mapping[str, str], exact_patient: bool = False
) -> DataFrame:
    return search(raw, "encounter", params, exact_patient)


def search_observations(
    raw: DataFrame, params: Mapping[str, str], exact_patient: bool = False
) -> DataFrame:
    return search(raw, "observation", params, exact_patient)


def search_total(
    raw: DataFrame, resource: str, params: Mapping[str, str], exact_patient: bool = False
) -> DataFrame:
    """Number of matches before paging."""
    return matching(raw, resource, params, exact_patient).agg(F.count(F.lit(1)).alias("total"))


def search_bundle(
    raw: DataFrame, resource: str, params: Mapping[str, str], exact_patient: bool = False
) -> DataFrame:
    """Page and total as one searchset Bundle."""
    return to_searchset_bundle(
        search(raw, resource, params, exact_patient),
        search_total(raw, resource, params, exact_patient),
        newest_first("sort_key", "id"),
    )


def _preset(patient_id: str, count: int, offset: int, **fixed: str | None) -> dict[str, str]:
    given = {k: v for k, v in fixed.items() if v}
    return {"patient": patient_id, "_count": str(count), "_offset": str(offset), **given}


def patient_encounters(
    raw: DataFrame, patient_id: str, count: int = DEFAULT_COUNT, offset: int = 0
) -> DataFrame:
    return search_encounters(raw, _preset(patient_id, count, offset))


def patient_observations(
    raw: DataFrame,
    patient_id: str,
    code: str | None = None,
    count: int = DEFAULT_COUNT,
    offset: int = 0,
) -> DataFrame:
    return search_observations(raw, _preset(patient_id, count, offset, code=code))


def vital_signs(
    raw: DataFrame, patient_id: str, count: int = DEFAULT_COUNT, offset: int = 0
) -> DataFrame:
    return search_observations(raw, _preset(patient_id, count, offset, category="vital-signs"))


def lab_results(
    raw: DataFrame, patient_id: str, count: int = DEFAULT_COUNT, offset: int = 0
) -> DataFrame:
    return search_observations(raw, _preset(patient_id, count, offset, category="laboratory"))


def _on_day(ts: str, day: str) -> Column:
    """The day as a half-open range, which the scan can use."""
    start = F.lit(day).cast("date").cast("timestamp_ntz")
    end = F.date_add(F.lit(day).cast("date"), 1).cast("timestamp_ntz")
    return (F.col(ts) >= start) & (F.col(ts) < end)


def search_patients(
    df: DataFrame, params: Mapping[str, str], names: SubstringIndex | None = None
) -> DataFrame:
    """Over ``patient_id, external_identifier, gender, birth_date, name_search_index, updated_at``.

    With an index of the names by ``patient_id`` a part of a name is looked for among its candidates.
    """
    found = df
    if identifier := params.get("identifier"):
        found = found.filter(F.col("external_identifier") == identifier)
    if gender := params.get("gender"):
        found = found.filter(F.col("gender") == gender.lower())
    if birthdate := params.get("birthdate"):
        found = found.filter(F.col("birth_date") == F.lit(birthdate).cast("date"))
    if name := params.get("name"):
        if names:
            found = names.narrowed(found, "patient_id", name)
        found = found.filter(F.col("name_search_index").ilike(_like(f"%{name}%")))
    return order_desc_page(found, "updated_at", "patient_id", Page.of(params))


def search_encounters_by_day(mart: DataFrame, params: Mapping[str, str]) -> DataFrame:
    """Over the encounter mart; the date matches the whole day, the patient exactly."""
    found = mart
    for name, column in {"patient": "patient_id", "status": "status"}.items():
        if value := params.get(name):
            found = found.filter(F.col(column) == value)
    if day := params.get("date"):
        found = found.filter(_on_day("period_start", day))
    return order_desc_page(found, "period_start", "encounter_id", Page.of(params))


def search_observations_by_day(mart: DataFrame, params: Mapping[str, str]) -> DataFrame:
    """Over the observation mart; several codes are alternatives."""
    found = mart
    for name, column in {"patient": "patient_id", "category": "category_code"}.items():
        if value := params.get(name):
            found = found.filter(F.col(column) == value)
    if code := params.get("code"):
        found = found.filter(F.col("code").isin(*_codes(code)))
    if day := params.get("date"):
        found = found.filter(_on_day("effective_datetime", day))
    return order_desc_page(found, "effective_datetime", "observation_id", Page.of(params))
