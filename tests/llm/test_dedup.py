"""Line, string and near-duplicate removal against plain Python."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from medloom.llm import line_dedup, near_duplicates, suffix_dedup
from medloom.llm.near_duplicates import BKTree
from medloom.llm.simhash import fingerprint, shingle_hashes
from tests.compare import connect, mismatch
from tests.llm.conftest import SF, pairs


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def plain_lines(docs):
    holders = {}
    keyed = []
    for doc_id, text in docs:
        lines = [(x, line_dedup.line_key(x)) for x in text.split("\n")]
        keyed.append((doc_id, lines))
        for _, k in lines:
            holders.setdefault(k, set()).add(doc_id)
    out = []
    for doc_id, lines in keyed:
        kept = []
        for x, k in lines:
            own = holders[k]
            keeper = max((i for i in own if i is not None), default=None)
            if k is None or len(own) < 5 or doc_id == keeper:
                kept.append(x)
        out.append((doc_id, len(lines), len(lines) - len(kept), sha("\n".join(kept).encode())))
    return Counter(out)


def plain_strings(docs, length):
    raws = [(i, t.encode()) for i, t in docs]
    seen = Counter(raw[p : p + length] for _, raw in raws for p in range(len(raw) - length + 1))
    out = []
    for i, raw in raws:
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - length + 1):
            if seen[raw[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int((np.diff(np.insert(gone.astype(int), 0, 0)) == 1).sum())
        out.append((i, len(raw), int(gone.sum()), spans, sha(np.frombuffer(raw, np.uint8)[~gone[:-1]].tobytes())))
    return Counter(out)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_lines_match_sql(spark, documents):
    assert mismatch(line_dedup.digests(spark, documents), connect(SF), line_dedup.SQL) is None


def test_lines_edges(spark, edges, no_documents):
    assert rows(line_dedup.digests(spark, edges)) == plain_lines(pairs(edges))
    assert line_dedup.digests(spark, no_documents).count() == 0


def test_index_takes_documents_in_and_out(spark, documents, edges):
    docs = documents.select("doc_id", "text").union(edges.selectExpr("doc_id + 10000", "text"))
    some, others = docs.where("doc_id % 3 = 0"), docs.where("doc_id % 3 <> 0 OR doc_id IS NULL")
    small = line_dedup.LineIndex.build(some, min_docs=2)
    full = small.insert(others)
    whole = line_dedup.LineIndex.build(docs, min_docs=2)
    assert rows(full.counts.select("key", "n_docs", "keeper")) == rows(whole.counts.select("key", "n_docs", "keeper"))
    assert rows(full.dropped()) == rows(whole.dropped())
    back = full.delete(others.select("doc_id"))
    assert rows(back.counts.select("key", "n_docs", "keeper")) == rows(small.counts.select("key", "n_docs", "keeper"))
    assert rows(back.dropped()) == rows(small.dropped())
    assert rows(back.filters.select("shard", "n_keys")) == rows(small.filters.select("shard", "n_keys"))


def test_lines_without_broadcast_filters(monkeypatch, spark, documents):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    assert mismatch(line_dedup.digests(spark, documents), connect(SF), line_dedup.SQL) is None


def test_cuckoo_filter():
    keys = np.random.default_rng(1).integers(0, 2**63, 4000, dtype=np.uint64)
    made = line_dedup.CuckooFilter.holding(keys)
    assert made.contains(keys).all()
    made.delete(keys[:2000])
    assert made.contains(keys[2000:]).all()
    assert made.contains(keys[:2000]).mean() < 0.01
    assert (line_dedup.CuckooFilter.from_bytes(made.to_bytes()).table == made.table).all()


@pytest.mark.parametrize("crowded", [1, 128])
def test_strings_edges(monkeypatch, spark, documents, edges, no_documents, crowded):
    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    docs = documents.select("doc_id", "text").union(edges.selectExpr("doc_id + 10000", "substr(text, 1, 20000)"))
    assert rows(suffix_dedup.digests(docs)) == plain_strings(pairs(docs), 200)
    assert suffix_dedup.digests(no_documents).count() == 0


def test_strings_of_other_lengths(monkeypatch, spark):
    monkeypatch.setattr(suffix_dedup, "PIECE", 64)
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("ab"), size=rng.integers(0, 400))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = suffix_dedup.dedup_strings(docs, length=13, bucket_bytes=4)
    found = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in kept.collect())
    assert found == plain_strings(pairs(docs), 13)


def plain_components(docs):
    prints = [(i, fingerprint(shingle_hashes(t, 3))) for i, t in docs]
    distinct = sorted({p for _, p in prints})
    root = {p: p for p in distinct}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for k, a in enumerate(distinct):
        for b in distinct[:k]:
            if (a ^ b).bit_count() <= 3:
                root[top(a)] = top(b)
    first = {}
    for i, p in prints:
        if i is not None:
            first[top(p)] = min(i, first.get(top(p), i))
    return Counter((i, f"{p:016x}", first.get(top(p))) for i, p in prints)


@pytest.mark.parametrize("shard_rows", [1, 256])
def test_near_duplicates(monkeypatch, documents, edges, no_documents, shard_rows):
    monkeypatch.setattr(near_duplicates, "SHARD_ROWS", shard_rows)
    docs = documents.select("doc_id", "text").union(edges.select("doc_id", "text"))
    assert rows(near_duplicates.near_duplicates(docs)) == plain_components(pairs(docs))
    assert near_duplicates.near_duplicates(no_documents).count() == 0


def test_fingerprint_by_hand():
    from xxhash import xxh64_intdigest

    words = "the quick brown fox jumps".split()
    hashes = [xxh64_intdigest(" ".join(words[k : k + 3]), 42) for k in range(3)]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) >= 2)
    assert fingerprint(shingle_hashes("The  QUICK\nbrown fox jumps", 3)) == want
    assert fingerprint(shingle_hashes("One word", 3)) == xxh64_intdigest("one word", 42)
    assert fingerprint(shingle_hashes(" \n", 3)) == 0


def test_bk_tree():
    rng = np.random.default_rng(5)
    values = sorted({int(x) for x in rng.integers(0, 1 << 16, 600)})
    tree = BKTree()
    for v in values:
        tree.add(v)
    for v in values[:50]:
        assert {tree.values[k] for k in tree.within(v, 3)} == {w for w in values if (v ^ w).bit_count() <= 3}


def test_long_chain_is_one_component(spark):
    # Each number is one bit from the next: the smallest must reach the end of the chain.
    values = [(1 << k) - 1 for k in range(60)]
    prints = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    found = near_duplicates.components(near_duplicates.links(prints, 1)).collect()
    assert {(r.u, r.root) for r in found} == {(v, 0) for v in values[1:]}
