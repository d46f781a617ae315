"""Periodic runs against brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from medloom.llm import periodic_runs, queries
from tests.llm.conftest import SF, pairs


def plain_runs(words, min_words=6, min_repeats=4):
    """Every maximal run: each period is compared along the whole text."""
    known = {w: k for k, w in enumerate(words)}
    x = np.array([known[w] for w in words], np.int64)
    runs = {}
    for q in range(1, len(x) // min_repeats + 1):
        same = np.concatenate([[False], x[q:] == x[:-q], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for start, end in zip(edge[::2].tolist(), edge[1::2].tolist()):
            length = end - start + q
            if length >= max(min_words, min_repeats * q):
                runs.setdefault((start, length), q)  # the first is the smallest
    return sorted((s, n, q) for (s, n), q in runs.items())


def plain_planted(doc_id, words):
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(words)
    if h is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_digest(doc_id, text):
    words = [w.decode() for w in text.encode().split()]
    words = plain_planted(doc_id, words)
    runs = plain_runs(words)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    listed = sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
    left = sha(" ".join(w for k, w in enumerate(words) if k not in gone))
    if not runs:
        return (doc_id, 0, None, None, None, None, listed, left)
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]))
    return (doc_id, len(runs), s, n, q, 1000 * n // q, listed, left)


@pytest.mark.parametrize("min_words, min_repeats", [(6, 4), (2, 3), (20, 5)])
def test_find_runs(min_words, min_repeats):
    rng = random.Random(min_words)
    for _ in range(400):
        documents = []
        for _ in range(rng.randrange(1, 5)):
            letters, n = rng.choice([1, 2, 3, 8]), rng.randrange(60)
            words = [rng.randrange(letters) for _ in range(n)]
            for _ in range(rng.randrange(3)):
                if n > 4:
                    start, q = rng.randrange(n), rng.randrange(1, 9)
                    for k in range(start + q, rng.randrange(start, n)):
                        words[k] = words[k - q]
            documents.append([b"%d" % w for w in words])
        numbers, starts = periodic_runs.word_numbers(documents)
        found = [[] for _ in documents]
        for s, n, q in zip(*(x.tolist() for x in periodic_runs.find_runs(numbers, min_words, min_repeats))):
            k = int(np.searchsorted(starts, s, side="right")) - 1
            found[k].append((s - int(starts[k]), n, q))
        assert found == [plain_runs(words, min_words, min_repeats) for words in documents]


def test_too_few_repeats():
    with pytest.raises(ValueError):
        periodic_runs.find_runs(np.arange(4), min_repeats=2)


def test_query_equals_brute_force(spark, documents):
    found = queries.QUERIES["op11_periodic_runs"](spark, SF)
    assert found.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    want = Counter(plain_digest(*row) for row in pairs(documents))
    assert Counter(map(tuple, found.collect())) == want
    assert sum(n for row, n in want.items() if row[1]) > 5


def test_edges(spark, edges):
    repeated = spark.createDataFrame(
        [(21, "go " * 70_000), (22, "a b c d e f " * 4), (23, "x " * 5), (24, "x " * 6), (None, "y z " * 9), (25, "A a " * 4)],
        "doc_id long, text string",
    )
    docs = edges.unionByName(repeated, allowMissingColumns=True)
    found = periodic_runs.digests(docs)
    assert Counter(map(tuple, found.collect())) == Counter(plain_digest(*row) for row in pairs(docs))


def test_outputs(spark, edges, no_documents):
    docs = spark.createDataFrame([(1, "see the the the the the the end", "u")], "doc_id long, text string, runs string")
    (row,) = periodic_runs.periodic_runs(docs, carry=["runs"]).collect()
    assert [tuple(r) for r in row.runs] == [(1, 6, 1)] and row.collapsed == "see the end" and row.carried.runs == "u"
    assert periodic_runs.digests(no_documents).count() == 0
    assert periodic_runs.periodic_runs(edges).count() == edges.count()
