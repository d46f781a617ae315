"""Periodic runs of words, found through a dictionary of basic factors.

For each power of two L every factor of L words gets a name, made from the names of its two
halves. Occurrences of a name that start at most L apart lie within twice the factor's length, so
they overlap or touch and form an arithmetic progression whose step is a period. A run of
smallest period q (L/2 < q <= L) and at least ``L + q`` words shows as a stretch of neighbouring
places whose next occurrence is q words on: its first place is the run's start, and its last one,
extended by L + q, the run's end. Places whose name occurs once leave the dictionary, so of plain
text little is left after a few levels. All documents of a batch are worked on as one sequence of
numbers; a number of its own after each document keeps factors from reaching across.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.llm._common import BLANK, carried_type, id_and_text, portions

MIN_WORDS = 6
MIN_REPEATS = 4
RUN = "struct<start: bigint, length: bigint, period: bigint>"


def word_numbers(documents: Sequence[Sequence[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all documents as numbers, no number in two documents, each document closed by a
    number used nowhere else; and the place where each starts (the end of the last one at the end)."""
    lengths = np.array([len(words) for words in documents], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    numbers = np.empty(starts[-1], np.int64)
    for words, at in zip(documents, starts.tolist()):
        known = dict(zip(words, range(at, at + len(words))))  # the place of a word's last occurrence
        numbers[at : at + len(words)] = [known[w] for w in words]
    numbers[starts[1:] - 1] = starts[1:] - 1
    return numbers, starts


def find_runs(
    numbers: np.ndarray, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of every maximal run with at least ``min_words`` words and
    ``min_repeats`` (3 or more) periods, by start, then period."""
    if min_repeats < 3:
        raise ValueError("a run must hold three periods to be seen at its level")
    total = len(numbers)
    # Names of the places still in the dictionary (ascending); -1 stands for a place that left it.
    names, places, length = numbers, np.arange(total), 1
    found = [np.empty((0, 3), np.int64)]
    while len(places):
        order = np.argsort(names[places], kind="stable")
        sorted_names, sorted_places = names[places][order], places[order]
        again = sorted_names[1:] == sorted_names[:-1]
        gap = sorted_places[1:] - sorted_places[:-1]
        # Smaller periods belong to an earlier level.
        near = again & (gap <= length) & (gap > length // 2)
        found.append(_stretches(sorted_places[:-1][near], gap[near], length))
        # The next level, from places whose name and whose second half's name occur again.
        twice = np.zeros(len(order), bool)
        twice[:-1] |= again
        twice[1:] |= again
        kept = np.sort(sorted_places[twice])
        rank = np.full(total, -1, np.int64)
        rank[sorted_places] = np.cumsum(np.concatenate([[0], ~again]))
        alive = np.zeros(total, bool)
        alive[kept] = True
        kept = kept[kept + length < total]
        kept = kept[alive[kept + length]]
        names = np.full(total, -1, np.int64)
        names[kept] = rank[kept] * total + rank[kept + length]
        places, length = kept, 2 * length
    runs = np.concatenate(found)
    start, end, period = runs.T
    enough = end - start >= np.maximum(min_words, min_repeats * period)
    start, end, period = start[enough], end[enough], period[enough]
    order = np.lexsort((period, start))
    return start[order], (end - start)[order], period[order]


def _stretches(places: np.ndarray, gaps: np.ndarray, length: int) -> np.ndarray:
    """Start, end and period of each stretch of neighbouring places with one gap."""
    order = np.lexsort((places, gaps))
    places, gaps = places[order], gaps[order]
    first = np.ones(len(places), bool)
    first[1:] = (gaps[1:] != gaps[:-1]) | (places[1:] != places[:-1] + 1)
    last = np.roll(first, -1)
    return np.stack([places[first], places[last] + length + gaps[first], gaps[first]], axis=1)


def periodic_runs(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    min_repeats: int = MIN_REPEATS,
    carry: Sequence[str] = (),
    **cols: str,
) -> DataFrame:
    """``doc_id, runs, collapsed``: every run of each text, and the text with one period of each left.

    ``runs`` is an array of (start, length, period) in words, by start, then period; runs may overlap.
    ``collapsed`` joins by one space the words that no run holds after its first period. Null, empty
    and blank texts have no runs and collapse to the empty text. Each input row gives a row, repeated
    rows and null ids too. Of the other columns those named in ``carry`` come along in the struct
    ``carried``; no input gives no rows.
    """
    d = id_and_text(docs, carry=carry, **cols)
    more = d.columns[2:]
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    names = ["doc_id", "runs", "collapsed", *more]

    def work(texts: list[str]) -> tuple[list[list[dict]], list[str]]:
        documents = [t.encode().split() for t in texts]
        numbers, starts = word_numbers(documents)
        start, length, period = find_runs(numbers, min_words, min_repeats)
        owner = np.searchsorted(starts, start, side="right") - 1
        # +1 where a run's later periods begin, -1 where they end: words under a sum above 0 go.
        depth = np.zeros(len(numbers) + 1, np.int64)
        np.add.at(depth, start + period, 1)
        np.add.at(depth, start + length, -1)
        gone = np.cumsum(depth)[:-1] > 0
        runs: list[list[dict]] = [[] for _ in texts]
        for k, s, n, q in zip(owner.tolist(), (start - starts[owner]).tolist(), length.tolist(), period.tolist()):
            runs[k].append({"start": s, "length": n, "period": q})
        collapsed = []
        for words, own, at in zip(documents, runs, starts.tolist()):
            if own:
                words = [w for w, drop in zip(words, gone[at : at + len(words)].tolist()) if not drop]
            collapsed.append(b" ".join(words).decode())
        return runs, collapsed

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in portions(batch["text"]):
                runs, collapsed = work(texts)
                columns = [pa.array(runs, pa.list_(run_type)), pa.array(collapsed, pa.string())]
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([part["doc_id"], *columns, *(part[c] for c in more)], names=names)
                at += len(texts)

    return d.mapInArrow(run, f"doc_id long, runs array<{RUN}>, collapsed string" + carried_type(d))


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` with a repetition written into about one text in ten, as the query asks.

    h is the crc32 of the decimal id, g = h div 10. If h mod 10 is 0, the n words from a = g mod n on
    repeat with period 1 + (n - a) div (3 + g mod 8). A null id has no h and its text stays.
    """
    d = id_and_text(docs, id_col, text_col)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", BLANK), lambda w: w != "")
    chosen = d.withColumns({"h": h}).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    sized = chosen.select("doc_id", "text", "words", F.floor(F.col("h") / 10).alias("g"), F.size("words").cast("bigint").alias("n"))
    a = F.col("g") % F.col("n")
    p = 1 + F.expr("(n - a) div (3 + g % 8)")
    again = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1),
        lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")),
    )
    placed = sized.withColumn("a", F.when(F.col("n") > 0, a)).withColumn("p", p)
    return placed.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def digests(docs: DataFrame, **cols: str) -> DataFrame:
    """Runs of the planted texts: their number, the longest one, and hashes of all and of what is left.

    Rows and nulls as in ``periodic_runs``; without a run the four columns of the longest are null.
    """
    found = periodic_runs(planted(docs, **cols))
    longest = F.array_max(F.transform("runs", _by_length)).alias("longest")
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select("*", longest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.period")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def _by_length(r: Column) -> Column:
    """The greatest of these is the longest run; of ties the smallest start, then period."""
    return F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))
