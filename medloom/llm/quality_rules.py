"""Quality rules: a table of thresholds compiled into one projection of built-in expressions."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.llm._common import BLANK, held_in_row, id_and_text

WINDOW = 3
SYMBOLS = "#*$%&|<>"

# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in that is was for on with as by at from it be are this an "
    "der die das und ist den von zu mit sich des auf für im dem nicht ein eine als "
    "de la le les et des en un une du que pour dans par sur est qui au "
    "el los las y del se una por con para su al lo no"
).split()


class Rule(NamedTuple):
    """``measure`` must lie within [least, most]; None leaves an end open."""

    measure: str
    least: float | None
    most: float | None


RULES = (
    Rule("n_words", 50, None),
    Rule("mean_word_chars", 2.0, 20.0),
    Rule("symbol_ratio", None, 0.2),
    Rule("stop_word_ratio", 0.005, None),
    Rule("dup_line_ratio", None, 0.6),
    Rule("repeat_ratio", None, 0.5),
)

# What each ratio is made of; a ratio over nothing is null and passes no bound.
RATIOS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "n_words"),
    "stop_word_ratio": ("n_stop_words", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_word_lines"),
    "repeat_ratio": ("n_repeat_words", "n_words"),
}


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the counts the rules need, one row per input row.

    Null and empty texts have zero in every count; null ids stay null; repeated rows each give a
    row; other columns of the input are not read.
    """
    d = id_and_text(docs, id_col, text_col)
    words = F.filter(F.split("text", BLANK), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.regexp_replace(x, BLANK, "")) > 0)
    d = held_in_row(d, words=words, lines=lines)
    d = held_in_row(d, n=F.size("words"), windows=_windows(F.col("words")))
    d = held_in_row(d, sorted=_sorted_if_repeated(F.col("windows")))
    d = held_in_row(d, places=_repeated_places(F.col("sorted")))
    n_word_lines = F.size("lines")
    return d.select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("text", BLANK, "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (n_word_lines - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _covered(F.col("places")).cast("bigint").alias("n_repeat_words"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("bigint").alias("n_stop_words"),
        n_word_lines.cast("bigint").alias("n_word_lines"),
    )


def _windows(words: Column) -> Column:
    """A 64-bit key for each window of three words."""
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    keys = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    return F.when(F.size(words) >= WINDOW, keys).otherwise(F.array().cast("array<bigint>"))


def _sorted_if_repeated(windows: Column) -> Column:
    """(key, place) in key order; empty where no key comes twice."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), placed).otherwise(none)


def _repeated_places(placed: Column) -> Column:
    """Ascending starts of the windows that have an equal neighbour in key order."""
    twice = F.filter(
        placed,
        lambda x, i: F.coalesce(F.get(placed, i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(placed, i + 1)["h"] == x["h"], F.lit(False)),
    )
    return F.sort_array(F.transform(twice, lambda x: x["i"]))


def _covered(places: Column) -> Column:
    """Words covered by windows that start at the given places."""
    own = F.transform(
        places, lambda p, i: F.least(F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))
    )
    return F.aggregate(own, F.lit(0), lambda a, x: a + x)


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The table of thresholds as one boolean expression over the columns of ``measures``."""

    def value(name: str) -> Column:
        if name not in RATIOS:
            return F.col(name)
        part, whole = RATIOS[name]
        return F.col(part) / F.nullif(F.col(whole), F.lit(0))

    tests = []
    for rule in rules:
        if rule.least is not None:
            tests.append(F.coalesce(value(rule.measure) >= rule.least, F.lit(False)))
        if rule.most is not None:
            tests.append(F.coalesce(value(rule.measure) <= rule.most, F.lit(False)))
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, **cols: str) -> DataFrame:
    """``measures`` with ``base_failed`` and ``kept``.

    A text without a word fails. Documents whose measures lie on a bound pass it.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        measures(docs, **cols)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & verdict(rules))
    )


def _sql() -> str:
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    blank = r"[\x20\x09-\x0D]+"
    return f"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '{blank}'), lambda w: w <> '') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: length(regexp_replace(x, '{blank}', '', 'g')) > 0) AS lines
    FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d),
windows AS (SELECT doc_id, i, words[i : i + 2] AS w FROM starts),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n
            FROM twice, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id),
m AS (
    SELECT d.doc_id, len(words)::BIGINT AS n_words,
           length(regexp_replace(text, '{blank}', '', 'g'))::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
           len(list_filter(words, lambda w: lower(w) IN ({stop})))::BIGINT AS n_stop_words,
           len(lines)::BIGINT AS n_word_lines
    FROM d LEFT JOIN covered USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 20 * n_words
          AND n_symbols / n_words <= 0.2 AND n_stop_words / n_words >= 0.005
          AND n_dup_lines / n_word_lines <= 0.6 AND n_repeat_words / n_words <= 0.5 AS kept
FROM f"""


SQL = _sql()
