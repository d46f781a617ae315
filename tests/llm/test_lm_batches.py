"""What the counting of words and pairs hands on at once is bounded, and counted over portions first."""

import random
from collections import Counter

import pyarrow as pa

from medloom.llm import lm_scoring as lm


class _Taken:
    """Keeps the function that a frame would run in its tasks."""

    def mapInArrow(self, run, schema):  # noqa: N802
        self.run = run
        return self

    def groupBy(self, *names):  # noqa: N802
        return self

    def agg(self, *columns):
        return self


def test_counts_in_small_batches(spark):
    rng = random.Random(5)
    text = " ".join(f"w{rng.randrange(2000)}" for _ in range(400_000))
    docs = [text, "", text, text]
    taken = _Taken()
    lm._counts(taken)
    found = list(taken.run([pa.record_batch({"text": pa.array(docs)})]))
    words, pairs = Counter(), Counter()
    for own in map(lm.tokens, docs):
        words.update(own)
        pairs.update(zip([lm.END, *own], own))
    assert sum(len(t) for t in docs) > 4 << 20
    assert max(b.num_rows for b in found) < len(pairs) / 2
    rows = [r for b in found for r in b.to_pylist()]
    assert len(rows) == len(words) + len(pairs)
    assert {r["word"]: r["n"] for r in rows if r["word"] is not None} == words
    assert sorted(r["n"] for r in rows if r["word"] is None) == sorted(pairs.values())
