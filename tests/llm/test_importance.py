"""Importance resampling against plain Python and SQL; the quickselect against a sort."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from medloom.llm import importance, queries
from tests.compare import connect, mismatch
from tests.llm.conftest import SF, pairs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def plain_buckets(text, buckets=10_000):
    words = plain_words(text)
    features = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return [zlib.crc32(f.encode()) % buckets for f in features]


def plain_resample(docs, target, percent=25, min_words=20):
    source, aim = Counter(), Counter()
    for _, text in docs:
        source.update(plain_buckets(text))
    for text in target:
        aim.update(plain_buckets(text))
    big_s, big_t = source.total() + 10_000, aim.total() + 10_000
    gain = {b: math.floor(1000 * math.log((aim[b] + 1) * big_s / ((source[b] + 1) * big_t))) for b in range(10_000)}
    rows = []
    for doc_id, text in docs:
        own = plain_buckets(text)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        name = "" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"7:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(own), weight, score, len(plain_words(text)) >= min_words))
    fit = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1]))
    drawn = Counter((*r[:4], k + 1) for k, r in enumerate(fit[: percent * len(fit) // 100]))
    lost = Counter((*r[:4], None) for r in [*fit[percent * len(fit) // 100 :], *(r for r in rows if not r[4])])
    return drawn + lost


def test_buckets():
    text = "Abc,ABC déjà-vu 9_9\x7fİx  y"
    assert sorted(importance.feature_buckets(text, 10_000).tolist()) == sorted(plain_buckets(text))
    assert len(importance.feature_buckets(" ,;_ ", 10)) == 0


def test_query_equals_brute_force_and_sql(spark, documents):
    found = queries.QUERIES["op13_importance_resampling"](spark, SF)
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert Counter(map(tuple, found.collect())) == plain_resample(pairs(documents), target)
    assert mismatch(found, connect(SF), importance.SQL) is None


@pytest.mark.parametrize("percent", [0, 1, 50, 100])
def test_edges(spark, edges, percent):
    rng = random.Random(3)
    words = ["a", "be", "see", "é", "dee", "x1"]
    more = [(k // 3 if k % 4 else None, " ".join(rng.choices(words, k=rng.randrange(15, 40)))) for k in range(60)]
    more += [(7, "one and the same text, again and again " * 4)] * 90 + [(8, None)]
    docs = edges.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    target = spark.createDataFrame([("a be é", 1), (None, 2), ("", 3)], "text string, rank int")
    found = importance.resample(docs.repartition(7), target, percent=percent)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, found.collect())) == plain_resample(pairs(docs), ["a be é"], percent)


def test_empty(spark, edges, no_documents):
    target = spark.createDataFrame([], "text string")
    assert importance.resample(no_documents, target).count() == 0
    assert Counter(map(tuple, importance.resample(edges, target).collect())) == plain_resample(pairs(edges), [])


def test_select_kth(spark):
    rng = random.Random(5)
    values = [(rng.randrange(-5, 500), rng.random() < 0.1, rng.randrange(3), rng.randrange(2)) for _ in range(3000)]
    values += [(7, False, 1, 1)] * 1500  # a third of all rows is one key
    rows = spark.createDataFrame(values, "down long, no_id boolean, id long, fewer long").withColumn("more", F.lit(1))
    values.sort()
    for k in (1, 2, 100, 1000, 2250, len(values)):
        assert tuple(importance.select_kth(rows, k, pivots=5)) == values[k - 1]
    assert importance.select_kth(rows, len(values) + 1) is None and importance.select_kth(rows.limit(0), 1) is None
