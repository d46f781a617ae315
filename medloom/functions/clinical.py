"""Derived clinical columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from medloom.schemas import (
    ABNORMAL_INTERPRETATIONS,
    ACTIVE_ENCOUNTER_STATUS,
    OBSERVATION_CATEGORIES,
)


def age_years(birth: Column, deceased: Column, as_of: str) -> Column:
    """Difference of calendar years up to death or ``as_of`` (not completed years)."""
    end = F.coalesce(F.year(deceased), F.year(F.lit(as_of).cast("date")))
    return (end - F.year(birth)).cast("bigint")


def encounter_duration_hours(start: Column, end: Column) -> Column:
    """Number of full-hour marks crossed; null unless both ends are known."""
    hours = [F.unix_seconds(F.date_trunc("hour", c).cast("timestamp")) for c in (end, start)]
    return F.floor((hours[0] - hours[1]) / 3600).cast("bigint")


def encounter_is_active(status: Column) -> Column:
    return status.isin(*ACTIVE_ENCOUNTER_STATUS)


def number_text(value: Column) -> Column:
    """A double as text: no trailing ``.0``, no exponent between 1e-9 and 1e15."""
    text = value.cast("string")
    digits = F.regexp_replace(value.try_cast("decimal(38,15)").cast("string"), r"\.?0+$", "")
    spelled_out = text.contains("E") & F.abs(value).between(1e-9, 1e15)
    return F.when(spelled_out, digits).otherwise(F.regexp_replace(text, r"\.0$", ""))


def observation_value_display(
    quantity: Column, unit: Column, text: Column, flag: Column, codeable: Column
) -> Column:
    """First known value as text; a quantity keeps its blank even without a unit."""
    return F.coalesce(
        F.concat(number_text(quantity), F.lit(" "), F.coalesce(unit, F.lit(""))),
        text,
        F.when(flag, "Yes").when(~flag, "No"),
        codeable,
    )


def observation_is_abnormal(
    interpretation: Column, quantity: Column, low: Column, high: Column
) -> Column:
    """Interpretation code decides first, then the reference range, else false."""
    flagged = interpretation.isin(*ABNORMAL_INTERPRETATIONS)
    outside = (quantity < low) | (quantity > high)
    ranged = quantity.isNotNull() & low.isNotNull() & high.isNotNull()
    return F.when(flagged, True).when(ranged, outside).otherwise(False)


def observation_category_type(category: Column) -> Column:
    return F.when(category.isin(*OBSERVATION_CATEGORIES), category).otherwise("other")
