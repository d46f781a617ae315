"""Bundles of resources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medloom.functions.documents import let, path, with_document
from medloom.schemas import BUNDLE_TYPES


def validate_bundle(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``bundle`` (parsed) and ``error`` (first broken rule, null when valid)."""
    parsed = with_document(df, body, "bundle")
    kind = path(".resourceType", doc="bundle")
    type_ = path(".type", doc="bundle")
    # Fixed value: the allowed types as they appear in the message.
    allowed = str(list(BUNDLE_TYPES))

    def shown(c: Column) -> Column:
        return F.coalesce(c, F.lit("None"))

    def entry_problem(lacking: Column) -> Column:
        first = F.array_position(lacking, True)
        return F.when(F.coalesce(F.size(lacking), F.lit(0)) <= 0, "Bundle contains no entries").when(
            first > 0,
            F.concat(
                F.lit("Entry "), (first - 1).cast("string"), F.lit(" missing 'resource' field")
            ),
        )

    error = (
        F.when(F.coalesce(F.length(body), F.lit(0)) == 0, "Request body is empty")
        .when(F.col("bundle").isNull(), "Invalid JSON")
        .when(
            ~kind.eqNullSafe("Bundle"),
            F.concat(F.lit("Expected resourceType 'Bundle', got '"), shown(kind), F.lit("'")),
        )
        .when(
            ~F.coalesce(type_.isin(*BUNDLE_TYPES), F.lit(False)),
            F.concat(
                F.lit("Unsupported bundle type: "), shown(type_), F.lit(f". Valid types: {allowed}")
            ),
        )
        .otherwise(
            let(
                F.transform(
                    path(".entry", "array<variant>", "bundle"),
                    lambda e: path(".resource", "variant", e).isNull(),
                ),
                entry_problem,
            )
        )
    )
    return parsed.withColumn("error", error)


def explode_bundle(df: DataFrame, doc: str = "bundle") -> DataFrame:
    """One row per contained resource; anything but a Bundle stands for itself.

    Empty resources are dropped. Other columns are kept.
    """
    others = [c for c in df.columns if c != doc]
    is_bundle = path(".resourceType", doc=doc).eqNullSafe("Bundle")
    inside = F.transform(
        path(".entry", "array<variant>", doc), lambda e: path(".resource", "variant", e)
    )
    parts = F.when(is_bundle, inside).otherwise(F.array(F.col(doc)))
    rows = df.select(*others, F.explode(parts).alias("record_content"))
    # Only resources without a type have to be looked at as a whole.
    typed = path(".resourceType", "variant").isNotNull()
    filled = F.col("record_content").isNotNull() & ~F.is_variant_null("record_content")
    return rows.filter(typed | (filled & (F.to_json("record_content") != "{}")))


def count_resources(df: DataFrame, keys: Sequence[str], doc: str = "bundle") -> DataFrame:
    """Resources by type within each bundle; an untyped resource counts as ``Unknown``."""
    entries = df.select(*keys, F.explode(path(".entry", "array<variant>", doc)).alias("_e"))
    type_ = F.coalesce(path(".resource.resourceType", doc="_e"), F.lit("Unknown"))
    return (
        entries.groupBy(*keys, type_.alias("resource_type"))
        .agg(F.count(F.lit(1)).alias("resource_count"))
    )


def entry_type_counts(doc: str = "bundle") -> Column:
    """The same counts inside one row, as a map: no explode, no shuffle."""
    types = F.transform(
        path(".entry", "array<variant>", doc),
        lambda e: F.coalesce(path(".resource.resourceType", doc=e), F.lit("Unknown")),
    )
    names = F.array_sort(F.array_distinct(types))
    counts = F.transform(
        names, lambda n: F.size(F.filter(types, lambda t: t == n)).cast("bigint")
    )
    return F.map_from_arrays(names, counts)


def resource_counts_by_type(df: DataFrame, doc: str = "record_content") -> DataFrame:
    """Resources by type over a whole frame."""
    type_ = F.coalesce(path(".resourceType", doc=doc), F.lit("Unknown"))
    return df.groupBy(type_.alias("resource_type")).agg(F.count(F.lit(1)).alias("resource_count"))


def to_searchset_bundle(page: DataFrame, total: DataFrame, order: Sequence[Column]) -> DataFrame:
    """A result page (at most 1000 rows by ``paginate``) and its total as one Bundle row.

    ``page`` holds ``record_content`` and the sort keys in ``order``; ``total`` is one row.
    """
    position = F.row_number().over(Window.orderBy(*order))
    entry = F.concat(F.lit('{"resource":'), F.to_json("record_content"), F.lit("}"))
    placed = page.select(F.struct(position.alias("position"), entry.alias("text")).alias("entry"))
    entries = F.transform(F.array_sort(F.collect_list("entry")), lambda e: e["text"])
    return placed.agg(
        F.concat(
            F.lit('{"resourceType":"Bundle","type":"searchset","total":'),
            total.scalar().cast("string"),
            F.lit(',"entry":['),
            F.array_join(entries, ","),
            F.lit("]}"),
        ).alias("bundle")
    )
