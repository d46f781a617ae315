"""Quality classifier: regularised quadratic discriminant over document statistics.

Statistics are taken once per text. Each class has a Gaussian over them; its covariance is shrunk
towards the diagonal of the pooled one. Scores are differences of log densities, from Mahalanobis
distances through Cholesky factors that are made once. All labelled rows take part in the fit:
only sums per class travel, not rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.llm._common import id_and_text, written

KEEP_SCORE = 0.3
SHRINKAGE = 0.1
# A floor for variances, in the (transformed) units of the statistics.
RIDGE = 1e-4
FEW_WORDS = 10
# No distance counts for more than this many log units between the classes.
MOST_LOG_ODDS = 30.0

STATISTICS = (
    "log_words",
    "log_word_chars",
    "distinct_words",
    "top_word",
    "repeated_next",
    "upper",
    "digits",
    "symbols",
    "marks",
    "sentence_ends",
    "repeated_lines",
    "repeated_text",
)

_UPPER = np.array([0x41 <= b <= 0x5A for b in range(256)])
_LETTER = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0xC3 for b in range(256)])
_DIGIT = np.array([0x30 <= b <= 0x39 for b in range(256)])
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>@^~_={}[]\\/+"))
_MARK = np.isin(np.arange(256), list(b"!?;:\"'()-"))


def statistics(text: str) -> tuple[float, ...]:
    """Transformed statistics of a text; all finite, also for an empty one."""
    raw = text.encode()
    words = raw.split()
    # Shares of few words or letters say little: the added constants pull them to zero.
    n = len(words) + FEW_WORDS
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters = int(by_byte[_LETTER].sum()) + 6 * FEW_WORDS
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x]
    pairs = len(set(zip(words, words[1:])))
    share = (
        max(counts.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        by_byte[_UPPER].sum() / letters,
        by_byte[_DIGIT].sum() / letters,
        by_byte[_SYMBOL].sum() / letters,
        by_byte[_MARK].sum() / letters,
        sum(w.endswith(b".") for w in words) / n,
        (len(lines) - len(set(lines))) / (len(lines) + 1),
        max(len(words) - 1 - pairs, 0) / n,
    )
    return (
        np.log1p(len(words)),
        np.log1p((sum(map(len, words)) + 6 * FEW_WORDS) / n),
        np.log((len(counts) + FEW_WORDS) / n),
        *np.sqrt(np.clip(share, 0.0, 4.0)).tolist(),
    )


def described(docs: DataFrame, **cols: str) -> DataFrame:
    """``doc_id`` and ``x`` (the statistics), a row per input row."""
    fields = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(x, pa.list_(pa.float64()))], schema=fields)

    return id_and_text(docs, **cols).mapInArrow(run, "doc_id long, x array<double>")


class ClassDensity(NamedTuple):
    log_prior: float
    mean: np.ndarray
    factor: np.ndarray  # inverse of the lower Cholesky factor of the covariance
    log_det: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        away = (x - self.mean) @ self.factor.T
        return self.log_prior - 0.5 * (self.log_det + (away * away).sum(axis=1))


class Discriminant(NamedTuple):
    """``good`` and ``bad`` densities; None if the labels do not hold both classes."""

    good: ClassDensity | None
    bad: ClassDensity | None
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.good is None or self.bad is None:
            return np.full(len(x), self.prior)
        odds = np.clip(self.good.log_density(x) - self.bad.log_density(x), -MOST_LOG_ODDS, MOST_LOG_ODDS)
        return 1 / (1 + np.exp(-odds))


def fit(labelled: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant:
    """Fits on all rows of ``x, label``; a task sends count, sums and products of each class."""
    width = len(STATISTICS)
    fields = pa.schema([("label", pa.int32()), ("place", pa.int32()), ("value", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {k: np.zeros((width + 1, width + 1)) for k in (0, 1)}
        for batch in batches:
            x = np.array(batch["x"].to_pylist(), float).reshape(-1, width)
            x = np.hstack([np.ones((len(x), 1)), x])
            label = np.array(batch["label"].to_pylist())
            for k in sums:
                own = x[label == k]
                sums[k] += own.T @ own
        for k, s in sums.items():
            columns = [pa.array([k] * s.size, pa.int32()), pa.array(range(s.size), pa.int32()), pa.array(s.ravel())]
            yield pa.RecordBatch.from_arrays(columns, schema=fields)

    rows = (
        labelled.select("x", F.col("label").cast("int").alias("label"))
        .where("label IN (0, 1)")
        .mapInArrow(run, "label int, place int, value double")
        .groupBy("label", "place")
        .agg(F.sum("value").alias("value"))
        .collect()  # two classes of (width + 1)^2 numbers
    )
    sums = np.zeros((2, (width + 1) ** 2))
    for r in rows:
        sums[r["label"], r["place"]] = r["value"]
    moments = sums.reshape(2, width + 1, width + 1)
    counts = moments[:, 0, 0]
    prior = float((counts[1] + 1) / (counts.sum() + 2))
    if counts.min() < 2:
        return Discriminant(None, None, prior)
    means = moments[:, 0, 1:] / counts[:, None]
    spread = [moments[k, 1:, 1:] / counts[k] - np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = sum(c * s for c, s in zip(counts, spread)) / counts.sum()
    target = np.diag(np.diag(pooled)) + RIDGE * np.eye(width)
    bad, good = (
        _density(np.log(counts[k] / counts.sum()), means[k], (1 - shrinkage) * spread[k] + shrinkage * target)
        for k in (0, 1)
    )
    return Discriminant(good, bad, prior)


def _density(log_prior: float, mean: np.ndarray, covariance: np.ndarray) -> ClassDensity:
    lower = np.linalg.cholesky(covariance)
    log_det = 2 * float(np.log(np.diag(lower)).sum())
    return ClassDensity(float(log_prior), mean, np.linalg.inv(lower), log_det)


def held_out(doc_id: Column) -> Column:
    """Whether a document's label may not be learned from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _fitted(docs: DataFrame, labels: DataFrame, cols: dict) -> tuple[DataFrame, Discriminant]:
    """Statistics of all documents, and the model fitted on the labelled ones."""
    rows = written(described(docs, **cols).withColumn("held_out", held_out(F.col("doc_id"))), "quality")
    own = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").alias("label"))
    return rows, fit(rows.where(~F.col("held_out")).join(own, "doc_id"))


def keep_good(docs: DataFrame, labels: DataFrame, keep_score: float = KEEP_SCORE, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that ``classify`` would predict 1.

    Texts are read twice and never shuffled.
    """
    model = _fitted(docs, labels, {"text_col": text_col})[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t.as_py() or "") for t in batch[text_col]]
            keep = model.score(np.array(x, float).reshape(-1, len(STATISTICS))) >= keep_score
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, keep_score: float = KEEP_SCORE, **cols: str) -> DataFrame:
    """``doc_id, held_out, score, predicted``: a row per input row.

    The score is the probability of quality 1. Learns from all labelled rows that are not held
    out; labels that are null, neither 0 nor 1 or without a document are left aside, a repeated
    label counts again. With fewer than two documents of either class each score is the share of
    label 1. Null and empty texts are scored like any other; a null id is held out; other columns
    are not read.
    """
    rows, model = _fitted(docs, labels, cols)
    fields = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(np.array(batch["x"].to_pylist(), float).reshape(-1, len(STATISTICS)))
            columns = [batch["doc_id"], batch["held_out"], pa.array(score), pa.array((score >= keep_score).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, schema=fields)

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
