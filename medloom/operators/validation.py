"""Checks on landed documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.functions.documents import (
    is_blank,
    is_json_object,
    path,
    with_default_meta,
    with_document,
)
from medloom.session import sized


# Up to this many failed files are broadcast.
BROADCAST_FILES = 100_000


class InvalidInput(Exception):
    """A landed file breaks a rule."""


def validate_ndjson(lines: DataFrame, mode: str = "quarantine") -> DataFrame:
    """Check lines; the first broken rule is kept in ``error``.

    Takes the output of ``read_ndjson_lines``. Blank lines are dropped. Line numbers in
    messages count from the first line of the file that is not blank. ``quarantine`` keeps
    bad rows with their error, ``failfast`` raises for the first bad line of a file.
    Valid rows get the parsed document and a ``meta`` key if they had none.
    """
    if mode not in ("quarantine", "failfast"):
        raise ValueError(f"unknown mode {mode}")
    line = (F.col("source_file_row_number") - F.col("first_text_row") + 1).cast("string")
    doc = F.col("record_content")
    problem = (
        F.when(doc.isNull(), F.concat(F.lit("Invalid JSON on line "), line))
        .when(~is_json_object("value"), F.concat(F.lit("Line "), line, F.lit(" is not a JSON object")))
        .when(
            path(".resourceType", "variant").isNull(),
            F.concat(F.lit("Missing 'resourceType' on line "), line),
        )
    )
    documents = with_document(lines.filter(~is_blank("value")), "value")
    checked = documents.withColumn("error", problem)
    if mode == "failfast":
        first = (
            checked.filter(F.col("error").isNotNull())
            .orderBy("source_file", "source_file_row_number")
            .select("source_file", "error")
            .first()
        )
        if first:
            raise InvalidInput(f"{first.source_file}: {first.error}")
    return checked


def add_default_meta(df: DataFrame, text: str = "value", doc: str = "record_content") -> DataFrame:
    """``meta: {}`` into documents that have no ``meta``; never overwrites."""
    return df.withColumn(text, with_default_meta(F.col(text), F.col(doc)))


def split_valid_quarantine(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows (ready to write) and rejected rows with their error.

    Both sides read ``checked``: hand in a table (``session.kept``) to have the input parsed once.
    """
    valid = add_default_meta(checked.filter(F.col("error").isNull())).drop("error")
    return valid, checked.filter(F.col("error").isNotNull()).drop("record_content")


def split_valid_quarantine_files(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole files pass or fail: one bad line keeps the complete file out.

    Finds the failed files at once, so that few of them cost the valid lines no shuffle.
    Reads ``checked`` twice: hand in a table (``session.kept``) to have the input parsed once.
    """
    failed = sized(
        checked.filter(F.col("error").isNotNull())
        .groupBy("source_file")
        .agg(F.min_by("error", "source_file_row_number").alias("error")),
        "failed-files",
        BROADCAST_FILES,
    )
    valid = add_default_meta(checked.join(failed, "source_file", "left_anti")).drop("error")
    return valid, failed


def filter_resource_type(df: DataFrame, type_: str) -> DataFrame:
    """Resources of one type, with the document as compact JSON in ``value``."""
    kept = df.filter(path(".resourceType") == type_)
    return kept.withColumn("value", F.to_json("record_content"))


def cast_failures(df: DataFrame, paths: dict[str, str]) -> DataFrame:
    """Values present in documents but not castable: ``path, failures`` per path."""
    counts = df.agg(
        *[
            F.count_if(_present(p) & _uncastable(p, t)).alias(p)
            for p, t in paths.items()
        ]
    )
    pairs = [F.struct(F.lit(p).alias("path"), F.col(f"`{p}`").alias("failures")) for p in paths]
    return counts.select(F.inline(F.array(*pairs)))


_WHOLE = ("bigint", "int", "smallint", "tinyint")


def _uncastable(expr: str, type_: str) -> Column:
    """A failed cast of a text to a whole number raises and drops an error for each row: texts that
    have no digits, or digits in two places, are no numbers and are not cast."""
    if type_ not in _WHOLE:
        return path(expr, type_).isNull()
    value = path(expr, "variant")
    text = F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))
    other = F.coalesce(~text.rlike("^[^0-9]*[0-9]+[^0-9]*$"), F.lit(False))
    return F.when(other, True).otherwise(F.try_variant_get(value, "$", type_).isNull())


def _present(expr: str) -> Column:
    return path(expr, "variant").isNotNull() & ~F.is_variant_null(path(expr, "variant"))
