"""Tokenizing, packing and language-model scores against the libraries and plain Python."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from medloom.llm import byte_bpe, lm_scoring, packing
from tests.llm.conftest import pairs

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "  a", "a \n b c", "a\n b", "x  y z", "a b  c", "日本語 テスト", "<|endoftext|> hi", "\x00\x01 z\x1cq",
    "😀😀 👩‍👩‍👧", "▁ a▁b", "!" * 500 + "ab1234567890", "don't WE'LL 12345", "İstanbul ΣΑΣ ﬁ é", "a" * 3000,
]


def all_rows(documents, edges):
    return documents.select("doc_id", "text").union(edges.select("doc_id", "text"))


def test_bpe_equals_the_library(spark, documents, edges, no_documents):
    import tiktoken

    tokens = byte_bpe.read_ranks(RANKS)
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: k for k, t in enumerate(tokens)}, special_tokens={}
    )
    codec = byte_bpe.Codec(tokens, public_tokenizers.PATTERN)
    for text, packed in zip(ODD, codec.encode(ODD)):
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text), text
        assert codec.decode(packed) == text.encode()
    docs = all_rows(documents, edges)
    want = Counter()
    for i, t in pairs(docs):
        ids = np.array(library.encode_ordinary(t), "<u4")
        want[i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()] += 1
    found = byte_bpe.digests(docs, RANKS, public_tokenizers.PATTERN)
    assert Counter(tuple(r) for r in found.collect()) == want
    assert byte_bpe.digests(no_documents, RANKS, public_tokenizers.PATTERN).count() == 0
    both = byte_bpe.encode_documents(edges.where("doc_id = 16"), RANKS, public_tokenizers.PATTERN).first()
    assert bytes(both.decoded).decode() == edges.where("doc_id = 16").first().text


def test_memo_may_be_full(monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMO_ENTRIES", 3)
    monkeypatch.setattr(packing, "MEMO_ENTRIES", 3)
    codec = byte_bpe.Codec(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    assert [codec.decode(x) for x in codec.encode(ODD)] == [t.encode() for t in ODD]
    words = packing.WordTokenizer(packing._read(WORDS))
    assert words.encode(ODD) == packing.WordTokenizer(packing._read(WORDS)).encode(ODD)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(WORDS)
    model.encode_special_tokens = True
    return lambda text: np.array([*model.encode(text, add_special_tokens=False).ids, 2], "<u4")


def test_word_ids_equal_the_library(library):
    for text, ids in zip(ODD, packing.WordTokenizer(packing._read(WORDS)).encode(ODD)):
        assert np.frombuffer(ids, "<u4").tolist() == library(text)[:-1].tolist(), text


@pytest.mark.parametrize("fan_in", [2, 64])
def test_packing(monkeypatch, documents, edges, no_documents, library, fan_in):
    monkeypatch.setattr(packing, "FAN_IN", fan_in)
    docs = all_rows(documents, edges).repartition(7)
    found = packing.pack(docs, WORDS, keep_ids=True).toPandas()
    want = Counter()
    for i, t in pairs(docs):
        want[-1 if i is None else i, library(t).tobytes()] += 1
    # Pieces of a document follow one another; equal rows may share their pieces out in any way.
    of_doc = Counter()
    for p in found.itertuples():
        doc = -1 if p.doc_id != p.doc_id else int(p.doc_id)
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        of_doc[doc] += p.length
        assert any(d == doc and ids[4 * p.start : 4 * (p.start + p.length)] == p.ids for d, ids in want)
    total = Counter()
    for (i, ids), n in want.items():
        total[i] += n * len(ids) // 4
    assert of_doc == total
    placed = found.sort_values(["sequence_id", "offset"])
    before = placed.groupby("sequence_id").length.cumsum() - placed.length
    assert (before == placed.offset).all()
    sizes = found.groupby("sequence_id").length.sum()
    assert sizes.max() <= 4096 and (4096 - sizes).sum() < 4096
    assert packing.pack(no_documents, WORDS).count() == 0


def test_packer_is_best_fit():
    out = []
    packer = packing.Packer(10, 2, lambda pieces: out.append([(p.doc_id, p.start, p.length) for p in pieces]))
    for k, n in enumerate((6, 8, 2, 25, 3)):
        packer.add(packing.Piece(k, 0, bytes(4 * n), n))
    # 2 fits 8 best; of 25 the full windows go out at once and 5 stays; 3 fits the 6.
    assert out == [[(1, 0, 8), (2, 0, 2)], [(3, 0, 10)], [(3, 10, 10)]]
    assert sum(p.length for p in packer.finish()) + sum(n for w in out[3:] for _, _, n in w) == 6 + 5 + 3


def held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 == 2


@pytest.mark.parametrize("head", [50, 300_000])
def test_base_scores(monkeypatch, documents, edges, no_documents, head):
    monkeypatch.setattr(lm_scoring, "HEAD_WORDS", head)
    docs = all_rows(documents, edges)
    texts = [(i, lm_scoring.tokens(t)) for i, t in pairs(docs)]
    counts = Counter(w for i, own in texts if not held(i) for w in own)
    n, z = sum(counts.values()), math.log10(sum(counts.values()) + len(counts) + 1)
    want = sorted(
        (str(i), len(own), sum(counts[w] > 0 for w in own), sum(math.log10(counts[w] + 1) - z for w in own)) for i, own in texts
    )
    rows = lm_scoring.score(docs).collect()
    found = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score) for r in rows)
    assert [f[:3] for f in found] == [w[:3] for w in want]
    assert np.allclose([f[3] for f in found], [w[3] for w in want])
    assert {r.train_tokens for r in rows} == {n}
    assert all(r.held_out == held(r.doc_id) and r.score < 0 for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert lm_scoring.score(no_documents).count() == 0


def test_no_training_rows(spark):
    docs = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    row = lm_scoring.score(docs).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
    assert math.isfinite(row.score)


def plain_scores(texts, train):
    """log10 probability of each text by quantised counts of words and pairs, as the model has them."""
    words, pair_counts = Counter(), Counter()
    for own in train:
        words.update(own)
        pair_counts.update(zip([lm_scoring.END, *own], own))
    n, weight = words.total(), min(max(1 - len(pair_counts) / max(words.total(), 1), 0), 0.9)

    def single(w):
        return math.floor(1.45 * 2 ** math.floor(math.log2(words[w]))) if words[w] else 0

    def pair(a, b):
        c = pair_counts[a, b]
        return 2.9 * 2 ** math.floor(math.log2(c / 2)) if c >= 2 else 0

    def p(a, b):
        before, own = single(a), single(b)
        share = weight * max(before - 1, 0) / (before + 1)
        return share * min(pair(a, b), own, before) / max(before, 1) + (1 - share) * (own + 1) / (n + len(words) + 1)

    return [sum(math.log10(p(a, b)) for a, b in zip([lm_scoring.END, *own], own)) for own in texts]


def test_model_scores(monkeypatch, documents, edges):
    """With bits enough for no false hits the scores are those of plain counts."""
    monkeypatch.setattr(lm_scoring, "BITS_PER_ENTRY", 600)
    docs = all_rows(documents, edges)
    texts = [(i, lm_scoring.tokens(t)) for i, t in pairs(docs)]
    want = plain_scores([own for _, own in texts], [own for i, own in texts if not held(i)])
    rows = lm_scoring.score(docs).collect()
    found = sorted((str(r.doc_id), r.n_tokens, r.score) for r in rows)
    want = sorted((str(i), len(own), w) for (i, own), w in zip(texts, want))
    assert [f[:2] for f in found] == [w[:2] for w in want]
    assert np.allclose([f[2] for f in found], [w[2] for w in want])


def test_filter_holds_levels(spark):
    rng = np.random.default_rng(2)
    hashes = rng.integers(-(2**63), 2**63, 3000)
    counts = rng.integers(2, 300, 3000)
    pairs_df = spark.createDataFrame(list(zip(hashes.tolist(), counts.tolist())), "pair long, n long")
    words = spark.createDataFrame([], "word binary, n long")
    made = lm_scoring.build_filter(words, pairs_df)
    want = np.floor(np.log2(counts / 2)).astype(int) + 1
    found = made.levels(hashes.view(np.uint64))
    assert (found >= want).all() and (found == want).mean() > 0.97
    absent = rng.integers(-(2**63), 2**63, 20000).view(np.uint64)
    assert (made.levels(absent) > 0).mean() < 0.02
    # A filter far too small for its entries: probing ends at the highest level.
    full = lm_scoring.build_filter(words, pairs_df, most_bytes=64)
    assert full.false_hits() > 0.9 and full.levels(absent).max() == made.highest == want.max()
