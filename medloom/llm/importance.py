"""Resampling of documents towards a target, by the importance of their hashed words and word pairs.

A feature's bucket is weighed by how much commoner it is in the target than in the documents; a
document's weight is the mean over its features, looked up in one array of all buckets. Gumbel
noise from a hash of the id makes the highest sums a draw without replacement. The cut between
drawn and not drawn is found by a distributed quickselect: a few keys taken at random divide what
is left, three-way counts (below, equal, above) say which part holds the k-th key, and only this
part is looked at again. Only the winners are sorted and ranked.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import window as W

from medloom.llm._common import id_and_text, portions, written

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
# Keys that divide what is left in one round.
PIVOTS = 16

# Every byte that is no digit, letter or part of a character beyond ASCII becomes a blank; A-Z is
# lower-cased before.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_CUT = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_WORDS = bytes(0x20 if _CUT.match(bytes([b])) else b for b in _FOLD)


def feature_buckets(text: str, buckets: int) -> np.ndarray:
    """Bucket of each word and each pair of neighbouring words, repeats included."""
    words = text.encode().translate(_WORDS).split()
    if not words:
        return np.empty(0, np.int64)
    # The checksum of "a b" goes on from that of "a".
    single = [crc32(w) for w in words]
    spaced = [b" " + w for w in words]
    double = map(crc32, spaced[1:], single)
    return np.fromiter(chain(single, double), np.int64, 2 * len(words) - 1) % buckets


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> dict[int, int]:
    """Features in each bucket over all documents. At most ``buckets`` numbers come to the driver,
    and a task gives at most that many to the shuffle."""
    fields = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for texts in portions(batch["text"]):
                own = np.concatenate([feature_buckets(text, buckets) for text in texts])
                counts += np.bincount(own, minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], schema=fields)

    counted = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    return {r["bucket"]: r["n"] for r in counted.collect()}


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Thousandths of the logarithm of target share by source share, for each bucket (add one)."""
    all_source, all_target = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    return [
        math.floor(
            1000 * math.log((target.get(b, 0) + 1.0) * all_source / ((source.get(b, 0) + 1.0) * all_target))
        )
        for b in range(buckets)
    ]


def weighed(docs: DataFrame, gain: list[int]) -> DataFrame:
    """``doc_id, n_words, n_features, weight``: the floored mean gain of each document's features."""
    sent = docs.sparkSession.sparkContext.broadcast(np.array(gain, np.int64))  # a number per bucket
    fields = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_words", "n_features", "weight")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = sent.value
        for batch in batches:
            counts, weights = [], []
            for texts in portions(batch["text"]):
                for text in texts:
                    own = feature_buckets(text, len(scores))
                    counts.append(len(own))
                    weights.append(int(scores[own].sum()) // max(len(own), 1))
            n = np.array(counts, np.int64)
            columns = [batch["doc_id"], pa.array((n + 1) // 2), pa.array(n), pa.array(weights, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=fields)

    return docs.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of standard Gumbel noise from a hash of the id (a null id: of the seed alone)."""
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(hexed, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


# The order of the draw, first to last: score down, id up (null last), features down. Rows that
# agree in all of it have the same result, so any order among them is the same.
KEY = ("down", "no_id", "id", "fewer")


def keyed(scored: DataFrame) -> DataFrame:
    return scored.select(
        "*",
        (-F.col("score")).alias("down"),
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        (-F.col("n_features")).alias("fewer"),
    )


def _literal(key: Row) -> Column:
    return F.struct(*[F.lit(key[c]).alias(c) for c in KEY])


def select_kth(rows: DataFrame, k: int, pivots: int = PIVOTS) -> Row | None:
    """The ``KEY`` of the k-th row (from 1) in ascending order; None if there is no such row.

    Each round draws at most ``pivots`` keys at random and counts, in one pass without a sort, the
    rows below, at and between them. Rounds grow with the logarithm of the number of distinct keys:
    a round with few keys left draws them all, and a drawn key never comes back.
    """
    left, turn = rows.select(*KEY), 0
    while True:
        turn += 1
        key = F.struct(*KEY)
        dice = F.xxhash64(F.lit(turn), *KEY)
        drawn = left.groupBy(F.pmod(dice, F.lit(pivots)).alias("part")).agg(F.min_by(key, dice).alias("key"))
        keys = sorted({tuple(r["key"]) for r in drawn.collect()})  # at most ``pivots``
        if not keys:
            return None
        bounds = [_literal(dict(zip(KEY, x))) for x in keys]
        # Part 2 i lies between two keys, part 2 i + 1 is a key itself.
        part = reduce(
            lambda rest, at: F.when(key < at[1], 2 * at[0]).when(key == at[1], 2 * at[0] + 1).otherwise(rest),
            reversed(list(enumerate(bounds))),
            F.lit(2 * len(bounds)),
        )
        counts = {r["part"]: r["n"] for r in left.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
        before, here = 0, 0
        while here <= 2 * len(keys) and before + counts.get(here, 0) < k:
            before += counts.get(here, 0)
            here += 1
        if here > 2 * len(keys):
            return None
        if here % 2:
            return Row(*KEY)(*keys[here // 2])
        k -= before
        inside = [key > bounds[here // 2 - 1]] if here else []
        inside += [key < bounds[here // 2]] if here < 2 * len(keys) else []
        left = written(left.where(reduce(Column.__and__, inside)), "left")


def ranked(winners: DataFrame, limit: int) -> DataFrame:
    """Adds ``rank`` in the order of ``KEY`` (1, 2, ...; null after ``limit``).

    The rows are sorted by range over many tasks. A row's rank is its place in its range plus the
    sizes of the ranges before; the window runs over one row per range.
    """
    table = written(winners, "winners")
    # Rows of one key go to several ranges: the place in the table breaks the tie, alike each time.
    where = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    order = [*KEY, "where"]
    sorted_rows = table.select("*", where.alias("where")).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(
        sorted_rows.select(*winners.columns, F.monotonically_increasing_id().alias("at")), "sorted"
    )
    # The upper bits of the number are the range, the lower 33 the place in it.
    part = F.shiftright("at", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = W.Window.orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    rank = F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    joined = placed.withColumn("part", part).join(written(starts, "starts"), "part")
    return joined.select(*winners.columns, F.when(rank <= limit, rank).alias("rank"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    **cols: str,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank``: every document, and the place of those drawn.

    Of the documents with at least ``min_words`` words ``percent`` % are drawn (floored), by score,
    ties by smaller id (a null id comes last), then by more features. Null and empty texts have no
    features, weight 0, and are never drawn. Repeated rows each count and give a row. ``target`` is
    read by its column ``text`` alone; other columns are not read. No documents give no rows; an
    empty target leaves its shares to the smoothing.
    """
    d = id_and_text(docs, **cols)
    aim = target.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    gain = gains(bucket_counts(d, buckets), bucket_counts(aim, buckets), buckets)
    scored = weighed(d, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    rows = written(keyed(scored), "scored")
    fit = rows.where(F.col("n_words") >= min_words)
    k = percent * fit.count() // 100
    last = select_kth(fit, k) if k else None
    columns = ["doc_id", "n_features", "weight", "score"]
    if last is None:
        return rows.select(*columns, F.lit(None).cast("bigint").alias("rank"))
    # The bound on the score alone reaches the scan.
    won = (F.col("n_words") >= min_words) & (F.col("down") <= last["down"]) & (F.struct(*KEY) <= _literal(last))
    lost = rows.where(~won).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    return ranked(rows.where(won), k).select(*columns, "rank").unionByName(lost)


_BYTE = "('0x' || substr(hexed, 2 * pos + 1, 2))::BIGINT"
SQL = f"""
WITH RECURSIVE bits AS (
    SELECT i AS byte, i AS c, 0 AS step FROM range(256) AS r(i)
    UNION ALL
    SELECT byte, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8),
crc_table AS (SELECT byte, c FROM bits WHERE step = 8),
texts AS (
    SELECT 's' AS side, row_number() OVER () AS node, doc_id, text FROM documents
    UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark),
worded AS (
    SELECT side, node, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
    FROM texts),
features AS (
    SELECT side, node, unnest(words) AS feature FROM worded
    UNION ALL
    SELECT side, node, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) FROM worded),
steps AS (
    SELECT feature, hex(encode(feature)) AS hexed, 0::BIGINT AS pos, 4294967295 AS c
    FROM (SELECT DISTINCT feature FROM features)
    UNION ALL
    SELECT feature, hexed, pos + 1, xor(s.c >> 8, t.c)
    FROM steps AS s JOIN crc_table AS t ON t.byte = xor(s.c & 255, {_BYTE}) WHERE 2 * pos < length(hexed)),
hashed AS (
    SELECT feature, xor(c, 4294967295) % {BUCKETS} AS bucket FROM steps WHERE 2 * pos = length(hexed)),
placed AS (SELECT side, node, bucket FROM features JOIN hashed USING (feature)),
counts AS (
    SELECT bucket, count(*) FILTER (WHERE side = 's') AS s, count(*) FILTER (WHERE side = 't') AS t
    FROM placed GROUP BY bucket),
gains AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts) + {BUCKETS})::DOUBLE
        / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts) + {BUCKETS})::DOUBLE)))::BIGINT AS gain
    FROM counts),
meant AS (
    SELECT node, sum(gain)::DOUBLE AS total, count(*)::BIGINT AS n
    FROM placed JOIN gains USING (bucket) WHERE side = 's' GROUP BY node),
scored AS (
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, len(words) AS n_words,
           coalesce(floor(total / n), 0)::BIGINT AS weight,
           floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
               / 4294967296)))::BIGINT AS noise
    FROM worded LEFT JOIN meant USING (node) WHERE side = 's'),
ordered AS (
    SELECT *, CASE WHEN n_words >= {MIN_WORDS} THEN row_number() OVER (
        PARTITION BY n_words >= {MIN_WORDS} ORDER BY weight + noise DESC, doc_id NULLS LAST, n_features DESC) END AS place
    FROM scored)
SELECT doc_id, n_features, weight, (weight + noise)::BIGINT AS score,
       CASE WHEN place <= (SELECT {PERCENT} * count(*) // 100 FROM ordered WHERE place IS NOT NULL) THEN place END::BIGINT AS rank
FROM ordered"""
