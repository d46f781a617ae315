"""Concept ids -> names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(concept: str, names: Mapping[int, str], default: str = "Other") -> Column:
    """Name from a short fixed list, so no lookup table has to be joined."""
    expr = F.lit(default)
    for concept_id, name in names.items():
        expr = F.when(F.col(concept) == concept_id, name).otherwise(expr)
    return expr
