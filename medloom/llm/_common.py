"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.session import scratch_dir

# The white space of the word contracts: space and the controls tab to carriage return.
BLANK = r"[\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """Only ``doc_id`` and ``text`` (null: empty), so that no other column of the input can clash.

    Columns to carry along come as one struct ``carried``, whatever their names.
    """
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *([F.struct(*carry).alias("carried")] if carry else []),
    )


def carried_type(df: DataFrame) -> str:
    """The carried column as the end of a schema text; empty if there is none."""
    if "carried" not in df.columns:
        return ""
    quoted = [f"`{f.name.replace('`', '``')}`: {f.dataType.simpleString()}" for f in df.schema["carried"].dataType]
    return f", carried struct<{', '.join(quoted)}>"


def held_in_row(df: DataFrame, **made: Column) -> DataFrame:
    """Adds columns that are computed once per row.

    A generator of one element is a border that the optimizer does not copy expressions across;
    without it an expression used inside a lambda would be computed again for each element.
    """
    made_as = F.struct(*[c.alias(name) for name, c in made.items()])
    kept = [c for c in df.columns if c not in made]
    return df.select(*kept, F.inline(F.array(made_as)))


def written(df: DataFrame, purpose: str, codec: str = "snappy") -> DataFrame:
    """The frame as a table in the shared folder: cuts the lineage and survives lost executors."""
    target = scratch_dir(df.sparkSession, purpose)
    df.write.option("compression", codec).parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def portions(texts: Iterable, chars: int = 1 << 20) -> Iterator[list[str]]:
    """Arrow texts as lists of Python strings of about ``chars`` characters together."""
    held, size = [], 0
    for text in texts:
        held.append(text.as_py())
        size += len(held[-1])
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held
