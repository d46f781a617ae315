"""Columns over JSON documents (text or VARIANT)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOC = "record_content"
_JSON_SPACE = " \t\r\n"


def path(expr: str, type_: str = "string", doc: str | Column = DOC) -> Column:
    """Value at a document path; null when absent or not castable.

    On a stored raw table the path is read by the Parquet scan as a leaf column.
    """
    return F.try_variant_get(doc, "$" + expr, type_)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strict_json(text: str | Column) -> Column:
    """Whole text as one VARIANT; null when it is not exactly one JSON value.

    ``try_parse_json`` stops after the first value, so ``{"a":1} x`` would pass. Parsing
    ``[<text>,"<md5 of text>"]`` leaves the hash in second place only when nothing
    follows the value.
    """
    text = F.col(text) if isinstance(text, str) else text
    mark = F.md5(text)
    return let(_pair(text, mark), lambda p: _first(p, mark))


def _pair(text: Column, mark: Column) -> Column:
    return F.try_parse_json(_marked(text, mark))


def _marked(text: Column, mark: Column) -> Column:
    return F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]'))


def _first(pair: Column, mark: Column) -> Column:
    marked = F.try_variant_get(pair, "$[1]", "string") == mark
    return F.when(marked, F.try_variant_get(pair, "$[0]", "variant"))


def with_document(df: DataFrame, text: str, name: str = DOC) -> DataFrame:
    """Add the parsed text (``strict_json``) as a column that is parsed once per row.

    A plain column would be copied into every filter pushed below it and parsed again there;
    the optimizer does not copy the output of a generator. In steps of such columns instead of
    the nested functions of ``let``, which are not compiled: the hash is taken once. Whether the
    hash comes second is read without building values, and the text is parsed as it is: a
    document taken out of a pair would be built a second time.
    """
    mark, second = "_document_mark", "_document_second"
    marked = df.withColumn(mark, F.md5(text))
    after = F.get_json_object(_marked(F.col(text), F.col(mark)), "$[1]")
    read = marked.select("*", F.explode(F.array(after)).alias(second))
    document = F.when(F.col(second) == F.col(mark), F.try_parse_json(text))
    return read.select("*", F.explode(F.array(document)).alias(name)).drop(mark, second)


def is_json_object(text: str | Column) -> Column:
    """True when a text already known to be JSON holds an object."""
    text = F.col(text) if isinstance(text, str) else text
    return F.ltrim(text, F.lit(_JSON_SPACE)).startswith("{")


# What Python's ``str.strip`` takes for white space.
_TEXT_SPACE = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def is_blank(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    # From the left alone: the first other character ends the search.
    return F.ltrim(text, F.lit(_TEXT_SPACE)) == ""


def with_default_meta(text: Column, doc: Column) -> Column:
    """Add ``"meta":{}`` to the text of an object that has no such key.

    The text is extended, not rebuilt, so numbers keep the way they were written.
    """
    body = F.rtrim(text, F.lit(_JSON_SPACE))
    head = F.rtrim(body.substr(F.lit(1), F.length(body) - 1), F.lit(_JSON_SPACE))
    comma = F.when(head.endswith("{"), F.lit("")).otherwise(F.lit(","))
    return F.when(
        path(".meta", "variant", doc).isNull(),
        F.concat(head, comma, F.lit('"meta":{}}')),
    ).otherwise(text)


def ref_id(reference: Column) -> Column:
    """Last segment of a reference such as ``Patient/12``."""
    return F.split_part(reference, F.lit("/"), F.lit(-1))


def extension_value(url: str, doc: str | Column = DOC) -> Column:
    """``valueInteger`` of the last extension with this url."""
    matching = F.filter(
        path(".extension", "array<struct<url:string,valueInteger:bigint>>", doc),
        lambda e: e["url"] == url,
    )
    return F.try_element_at(matching, F.lit(-1))["valueInteger"]
