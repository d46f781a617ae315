"""The filter has the same bits for every entry, however many there are, and its shards stay apart."""

import numpy as np

from medloom.llm import lm_scoring as lm


def test_bits_grow_with_entries(spark, monkeypatch):
    # More than 32 MB in all, in shards that are small.
    monkeypatch.setattr(lm, "BITS_PER_ENTRY", 30_000)
    monkeypatch.setattr(lm, "SHARD_ENTRIES", 100)
    rng = np.random.default_rng(4)
    hashes = rng.integers(-(2**63), 2**63, 10_000)
    pairs = spark.createDataFrame([(h, 2) for h in hashes.tolist()], "pair long, n long")
    made = lm.build_filter(spark.createDataFrame([], "word binary, n long"), pairs)
    assert made.shards == 100 and made.shards * made.shard_bits >= 30_000 * len(hashes)
    assert made.table.count() == made.shards
    assert (made.levels(hashes.view(np.uint64)) == 1).all()
    absent = rng.integers(-(2**63), 2**63, 10_000).view(np.uint64)
    assert not made.levels(absent).any() and made.false_hits() < 1e-6


def test_texts_in_several_chunks(spark, monkeypatch):
    """Scores don't depend on which texts share a chunk."""
    docs = spark.createDataFrame(
        [(i, " ".join(f"w{(i * k) % 23}" for k in range(1, 40 + i))) for i in range(40)], "doc_id long, text string"
    ).coalesce(1)
    one = {r.doc_id: r.score for r in lm.score(docs).collect()}
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        many = {r.doc_id: r.score for r in lm.score(docs).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(one) == 40 and np.allclose([one[i] for i in one], [many[i] for i in one])
