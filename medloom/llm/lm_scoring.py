"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are quantised to powers of two. An n-gram of level q goes into the
filter with each of 1..q; its level is read back by probing 1, 2, ... until the first miss. The
filter grows with the corpus: every entry has the same number of bits. It is built in shards of
bounded size by hash, which stay distributed. The texts are read in chunks; each sends the hashes of
its distinct n-grams to their shards, gets the levels back and is scored from these.

Besides the model's score there is an exact base score from single words. The commonest words
are looked up in a broadcast table of bounded length, all others by a join.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from medloom.llm._common import id_and_text, portions, written

HEAD_WORDS = 100_000
# Pairs enter the filter from this count on; rarer ones are left to smoothing.
LEAST_PAIR = 2
BITS_PER_ENTRY = 12
HASHES = 4
SHARD_ENTRIES = 400_000
# Distinct words a task counts before it hands them on, and pairs with their repeats.
FLUSH_WORDS = 200_000
FLUSH_PAIRS = 2_000_000
# Rows of a batch handed on, so that its reader needs little memory outside the heap.
HANDED_ROWS = 1 << 17
# Tokens of the texts that are scored together.
CHUNK_TOKENS = 2_000_000
# Probes at once, so that what they need stays in the processor's cache.
PROBES_AT_ONCE = 1 << 15

UPPER_TO_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
END = b" "  # no word holds a blank
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    z = x ^ np.uint64(salt * 0x632BE59BD9B4E019 & (1 << 64) - 1)
    z *= _A
    z ^= z >> np.uint64(30)
    z *= _B
    z ^= z >> np.uint64(27)
    return z


def _modulo(z: np.ndarray, n: int) -> np.ndarray:
    """In place; numpy divides by one number much faster than it takes remainders."""
    whole = z // np.uint64(n)
    whole *= np.uint64(n)
    z -= whole
    return z


def tokens(text: str) -> list[bytes]:
    """Lower-cased words and one end."""
    return [*text.encode().translate(UPPER_TO_LOWER).split(), END]


class Coded(NamedTuple):
    """Tokens of some texts, one after another, as places among their distinct words."""

    words: pa.Array  # distinct, so that each is hashed and looked up once
    codes: np.ndarray
    ends: np.ndarray  # place of each text's end

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], self.ends[:-1] + 1])


def coded(texts: list[str]) -> Coded:
    own = [tokens(t) for t in texts]
    encoded = pa.array(list(chain.from_iterable(own)), pa.binary()).dictionary_encode()
    return Coded(encoded.dictionary, encoded.indices.to_numpy(), np.cumsum([len(w) for w in own]) - 1)


class Hasher:
    """64-bit hashes of words."""

    def __init__(self):
        from xxhash import xxh64_intdigest

        self.digest = xxh64_intdigest

    def words(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.digest, words), np.uint64, len(words))

    @staticmethod
    def pairs(hashes: np.ndarray, ends: np.ndarray, end_hash: int) -> np.ndarray:
        """Hash of each word with the one before; after an end comes the end itself as context."""
        before = np.empty_like(hashes)
        before[1:] = hashes[:-1]
        before[np.concatenate([[0], ends[:-1] + 1])] = end_hash
        return _mixed(before, 1) + hashes * _B


class LogFilter(NamedTuple):
    """Bits of all shards, one after another."""

    bits: np.ndarray
    shards: int
    shard_bits: int
    highest: int  # level that any n-gram has

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """The level of each n-gram: probes until the first miss, or the highest level there is."""
        out = np.zeros(len(hashes), np.int64)
        if not self.shards:
            return out
        # Shard by shard, so that the probes of one shard find its bits in the processor's cache.
        order, shard = _order(hashes, self.shards)
        for start in range(0, len(order), PROBES_AT_ONCE):
            left = order[start : start + PROBES_AT_ONCE]
            self._probe(hashes[left], shard[left] * np.uint64(self.shard_bits), left, out)
        return out

    def _probe(self, hashes: np.ndarray, base: np.ndarray, left: np.ndarray, out: np.ndarray) -> None:
        level = 0
        while len(left) and level < self.highest:
            level += 1
            for i in range(HASHES):
                bit = _place(hashes, level, i, self.shard_bits)
                bit += base
                byte = self.bits[bit >> np.uint64(3)]
                hit = np.flatnonzero(byte >> (bit & np.uint64(7)).astype(np.uint8) & 1)
                if len(hit) < len(left):
                    left, hashes, base = left[hit], hashes[hit], base[hit]
            out[left] = level

    def false_hits(self) -> float:
        """Share of absent n-grams that pass one level."""
        ones = int(np.bitwise_count(self.bits).sum()) if self.shards else 0
        return (ones / max(len(self.bits) * 8, 1)) ** HASHES


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return _modulo(_mixed(hashes, 0), shards)


def _place(hashes: np.ndarray, level: int, i: int, shard_bits: int) -> np.ndarray:
    return _modulo(_mixed(hashes, 64 * level + i + 2), shard_bits)


def _own(hashes: np.ndarray) -> np.ndarray:
    """What tells n-grams of one shard apart: 40 bits, against some 400,000 entries."""
    return hashes >> np.uint64(24)


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers for a shuffle, the high bytes of all together: these repeat."""
    planes = numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, n: int, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = pa.decompress(packed, n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(dtype).reshape(n)


# What goes to a shard or, under a negative key, past all shards: rows of n hashes, or of n levels.
_BLOCK = "key long, chunk long, n long, body binary"
_BLOCK_FIELDS = pa.schema([("key", pa.int64()), ("chunk", pa.int64()), ("n", pa.int64()), ("body", pa.binary())])


def _order(hashes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that puts the hashes shard after shard, and the shard of each."""
    shard = _shard(hashes, shards)
    return np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable"), shard


def _blocks(hashes: np.ndarray, shards: int) -> tuple[np.ndarray, list[tuple[int, int, bytes]]]:
    """That order, and ``key, n, body`` of each shard that has any."""
    order, shard = _order(hashes, shards)
    dealt = _own(hashes[order])
    cuts = np.searchsorted(shard[order], np.arange(shards + 1, dtype=np.uint64))
    blocks = []
    for s, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
        if a < b:
            # Sorted hashes as steps have fewer bytes.
            blocks.append((s, b - a, _packed(np.diff(dealt[a:b], prepend=np.uint64(0)))))
    return order, blocks


class ShardedFilter(NamedTuple):
    """A filter whose shards stay in a table, so that no machine holds more than some of them."""

    table: DataFrame  # shard, bits
    shards: int
    shard_bits: int
    highest: int
    ones: int

    def probed(self, dealt: DataFrame) -> DataFrame:
        """Blocks of hashes, by ``key``, become blocks of levels; those under a negative key stay."""
        shard_bits, highest = self.shard_bits, self.highest

        def run(key: tuple, blocks: pa.Table, own: pa.Table) -> pa.Table:
            if key[0].as_py() is None or key[0].as_py() < 0 or not blocks.num_rows:
                return blocks
            bits = [np.frombuffer(b.as_buffer(), np.uint8) for b in own["bits"]]
            one = LogFilter(bits[0] if bits else np.zeros(0, np.uint8), len(bits), shard_bits, highest)
            bodies = []
            for n, body in zip(blocks["n"].to_pylist(), blocks["body"].to_pylist()):
                levels = one.levels(np.cumsum(_unpacked(body, n, np.uint64), dtype=np.uint64))
                bodies.append(_packed(levels.astype(np.uint8)))
            return blocks.set_column(blocks.schema.get_field_index("body"), "body", pa.array(bodies, pa.binary()))

        shards = self.table.withColumnRenamed("shard", "key")
        return dealt.groupBy("key").cogroup(shards.groupBy("key")).applyInArrow(run, _BLOCK)

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """Of hashes that the caller holds."""
        order, blocks = _blocks(hashes, self.shards)
        out = np.zeros(len(hashes), np.int64)
        if blocks:
            sent = self.table.sparkSession.createDataFrame([(s, 0, n, body) for s, n, body in blocks], _BLOCK)
            out[order] = _levels_of(self.probed(sent).toArrow())
        return out

    def false_hits(self) -> float:
        """Share of absent n-grams that pass one level."""
        return (self.ones / max(self.shards * self.shard_bits, 1)) ** HASHES


def _levels_of(blocks: pa.Table) -> np.ndarray:
    """Levels in the order of their shards."""
    rows = sorted(zip(blocks["key"].to_pylist(), blocks["n"].to_pylist(), blocks["body"].to_pylist()))
    return np.concatenate([np.zeros(0, np.uint8), *[_unpacked(body, n, np.uint8) for _, n, body in rows]])


class Grams(NamedTuple):
    """Distinct n-grams of a chunk, and the places of each token's word and pair among them."""

    hashes: np.ndarray
    words: np.ndarray
    pairs: np.ndarray


def _grams(words: np.ndarray, codes: np.ndarray, ends: np.ndarray, end_hash: int) -> Grams:
    """From the distinct hashes of words and the place of each token's word among these."""
    order = np.argsort(words)
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    pairs, token_pairs = np.unique(Hasher.pairs(words[codes], ends, end_hash), return_inverse=True)
    return Grams(np.concatenate([words[order], pairs]), place[codes], token_pairs + len(words))


class LanguageModel(NamedTuple):
    head_words: bytes  # the commonest words, set apart by line ends
    head_counts: np.ndarray
    train_tokens: int
    words: int  # distinct tokens
    pair_weight: float  # how often a pair in training is one that came before

    def head(self) -> dict[bytes, int]:
        """Exact counts of the commonest words."""
        return dict(zip(self.head_words.split(b"\n"), self.head_counts.tolist()))

    def log10_p(self, levels: np.ndarray, level: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of each token, given the one before; ``levels`` are those of the tokens' words, ``level`` of their pairs."""
        # Middle of what a level stands for; level 0 is not in the filter.
        own = np.floor(1.45 * 2.0 ** (levels - 1.0))
        pair = np.where(level > 0, 1.45 * LEAST_PAIR * 2.0 ** (level - 1.0), 0.0)
        before = np.empty_like(own)
        before[1:] = own[:-1]
        before[np.concatenate([[0], ends[:-1] + 1])] = own[ends[0]] if len(ends) else 0
        single = (own + 1) / (self.train_tokens + self.words + 1)
        # A pair is as common as its words at most, whatever the filter says.
        pair = np.minimum(pair, np.minimum(own, before))
        # No pair of a word seen once is in the filter; the more often it was seen, the more count.
        weight = self.pair_weight * np.maximum(before - 1, 0) / (before + 1)
        return np.log10(weight * pair / np.maximum(before, 1) + (1 - weight) * single)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of training; a null id is."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(True))


def _counts(docs: DataFrame) -> DataFrame:
    """``word, pair, n``: the words (``pair`` is null) and, by their hash, the word pairs (``word`` is
    null) of the given texts, from one pass over them."""
    names = ["word", "pair", "n"]

    def rows(words: pa.Array, pairs: pa.Array, n: pa.Array) -> Iterator[pa.RecordBatch]:
        whole = pa.RecordBatch.from_arrays([words, pairs, n], names=names)
        for start in range(0, len(n), HANDED_ROWS):
            yield whole.slice(start, HANDED_ROWS)

    def word_rows(counts: dict) -> Iterator[pa.RecordBatch]:
        words = pa.array(list(counts), pa.binary())
        return rows(words, pa.nulls(len(words), pa.int64()), pa.array(list(counts.values()), pa.int64()))

    def pair_rows(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        pairs, n = np.unique(np.concatenate(held), return_counts=True)
        return rows(pa.nulls(len(n), pa.binary()), pa.array(pairs.view(np.int64)), pa.array(n, pa.int64()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        hasher, counts, held, size = Hasher(), Counter(), [], 0
        end = int(hasher.words([END])[0])
        for b in batches:
            for texts in portions(b["text"], 4 << 20):
                text = coded(texts)
                words = text.words.to_pylist()
                counts.update(dict(zip(words, np.bincount(text.codes).tolist())))
                held.append(Hasher.pairs(hasher.words(words)[text.codes], text.ends, end))
                size += len(text.codes)
                if size >= FLUSH_PAIRS:
                    yield from pair_rows(held)
                    held, size = [], 0
                if len(counts) >= FLUSH_WORDS:
                    yield from word_rows(counts)
                    counts = Counter()
        if held:
            yield from pair_rows(held)
        yield from word_rows(counts)

    return docs.mapInArrow(run, "word binary, pair long, n long").groupBy("word", "pair").agg(F.sum("n").alias("n"))


def _hashed_words(counts: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in batches:
            hashes = hasher.words(b["word"].to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), b["n"]], names=["hash", "n"])

    return counts.mapInArrow(run, "hash long, n long")


def build_filter(words: DataFrame, pairs: DataFrame, most_bytes: int | None = None) -> ShardedFilter:
    """A filter of ``word, n`` and ``pair, n``: entries 1..q for each n-gram of level q.

    Grows with its entries, unless ``most_bytes`` are given.
    """
    level = lambda n: F.floor(F.log2(n)).cast("int") + 1
    of_pair = level(F.col("n") / LEAST_PAIR).alias("level")
    every = words.select(level(F.col("n")).alias("level")).union(pairs.select(of_pair))
    total, highest = every.agg(F.sum("level"), F.max("level")).first()
    entries = _hashed_words(words).select("hash", level(F.col("n")).alias("level")).union(pairs.select("pair", of_pair))
    total = total or 0
    shards = max(-(-total // SHARD_ENTRIES), 1)
    wanted = total * BITS_PER_ENTRY
    shard_bytes = -(-(wanted if most_bytes is None else min(wanted, most_bytes * 8)) // (8 * shards))

    def shard_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard = _shard(b["hash"].to_numpy().view(np.uint64), shards).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(shard), b["hash"], b["level"]], names=["shard", "hash", "level"])

    def made(key: tuple, own: pa.Table) -> pa.Table:
        hashes, levels = _own(own["hash"].to_numpy().view(np.uint64)), own["level"].to_numpy()
        bits = np.zeros(8 * shard_bytes, bool)
        for q in range(1, int(levels.max()) + 1):
            hashes, levels = hashes[levels >= q], levels[levels >= q]
            for i in range(HASHES):
                bits[_place(hashes, q, i, 8 * shard_bytes)] = True
        packed = np.packbits(bits, bitorder="little").tobytes()
        return pa.table({"shard": [key[0].as_py()], "bits": [packed], "ones": [int(bits.sum())]})

    dealt = entries.mapInArrow(shard_of, "shard long, hash long, level int")
    table = written(dealt.groupBy("shard").applyInArrow(made, "shard long, bits binary, ones long"), "lm-filter")
    ones = table.agg(F.sum("ones")).first()[0] or 0
    return ShardedFilter(table.select("shard", "bits"), shards, 8 * shard_bytes, highest or 0, ones)


_SCORED = "doc_id long, crc long, held_out boolean, n_tokens long, head_known long, head_log double, score double"
# Of each text before it has a score.
_BASE_FIELDS = pa.schema(
    [("doc_id", pa.int64()), ("crc", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64())]
    + [("head_known", pa.int64()), ("head_log", pa.float64())]
)


def _ends(base: pa.RecordBatch) -> np.ndarray:
    """Place of each text's end."""
    return np.cumsum(base["n_tokens"].to_numpy()) - 1


def _dealt(docs: DataFrame, sent: Broadcast, shards: int) -> DataFrame:
    """Blocks of the hashes of each chunk's n-grams, and under a negative key of its own the chunk itself:
    its texts' columns, its words' hashes and the place of each token's word among these."""

    def chunk_rows(number: int, held: list[tuple], end: int) -> pa.RecordBatch:
        bases, word_hashes, portion_codes = zip(*held)
        words, place = np.unique(np.concatenate(word_hashes), return_inverse=True)
        firsts = np.cumsum([0, *map(len, word_hashes)])
        codes = np.concatenate([place[first:][own] for first, own in zip(firsts, portion_codes)])
        # Common words first: small numbers take less room.
        common = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.int32)
        rank[common] = np.arange(len(words), dtype=np.int32)
        words, codes = words[common], rank[codes]
        base = pa.Table.from_batches(bases).combine_chunks().to_batches()[0]
        grams = _grams(words, codes, _ends(base), end)
        _, blocks = _blocks(grams.hashes, shards)
        body = pickle.dumps((base.serialize().to_pybytes(), words.tobytes(), _packed(codes)))
        keys, sizes, bodies = zip(*blocks, (-1 - number, len(codes), body))
        chunks = np.full(len(keys), number)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(chunks), pa.array(sizes, pa.int64()), pa.array(bodies, pa.binary())],
            schema=_BLOCK_FIELDS,
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hasher = sent.value, Hasher()
        end = int(hasher.words([END])[0])
        # What is known of the head's words, and a row for all others.
        place = {w: k for k, w in enumerate(model.head())}
        head_hashes = hasher.words(list(place))
        head_logs = np.append(np.log10(model.head_counts[: len(place)] + 1.0), 0.0)
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for b in batches:
            done = 0
            for texts in portions(b["text"], 4 << 20):
                text = coded(texts)
                words = text.words.to_pylist()
                at = np.fromiter((place.get(w, len(place)) for w in words), np.int64, len(words))
                known, rest = at < len(place), np.flatnonzero(at == len(place))
                hashes = np.empty(len(words), np.uint64)
                hashes[known] = head_hashes[at[known]]
                hashes[rest] = hasher.words([words[k] for k in rest.tolist()])
                sums = [np.add.reduceat(x[text.codes], text.starts) for x in (known.astype(np.int64), head_logs[at])]
                ids = [b[name].slice(done, len(texts)) for name in ("doc_id", "crc", "held_out")]
                made = map(pa.array, (np.diff(text.ends, prepend=-1), *sums))
                base = pa.RecordBatch.from_arrays([*ids, *made], schema=_BASE_FIELDS)
                held.append((base, hashes, text.codes))
                done += len(texts)
                size += len(text.codes)
                if size >= CHUNK_TOKENS:
                    yield chunk_rows(number, held, end)
                    number, held, size = number + 1, [], 0
        if held:
            yield chunk_rows(number, held, end)

    return docs.mapInArrow(run, _BLOCK)


def _scored(probed: DataFrame, sent: Broadcast, shards: int) -> DataFrame:
    """What the model says of each text, from the levels of its chunk."""

    def run(key: tuple, blocks: pa.Table) -> pa.Table:
        whole = pc.less(blocks["key"], 0)
        ((n, body),) = zip(*[blocks.filter(whole)[c].to_pylist() for c in ("n", "body")])
        base, words, codes = pickle.loads(body)
        base = pa.ipc.read_record_batch(pa.py_buffer(base), _BASE_FIELDS)
        ends, end = _ends(base), int(Hasher().words([END])[0])
        grams = _grams(np.frombuffer(words, np.uint64), _unpacked(codes, n, np.int32), ends, end)
        order, _ = _order(grams.hashes, shards)
        levels = np.empty(len(order), np.uint8)
        levels[order] = _levels_of(blocks.filter(pc.invert(whole)))
        p = sent.value.log10_p(levels[grams.words], levels[grams.pairs], ends)
        score = np.add.reduceat(p, np.concatenate([[0], ends[:-1] + 1]))
        return pa.Table.from_batches([base]).append_column("score", pa.array(score))

    return probed.groupBy("chunk").applyInArrow(run, _SCORED)


def _tail(docs: DataFrame, sent: Broadcast) -> DataFrame:
    """``word, doc_id, crc, n, first``: the words of each text that are not in the head; ``first``
    is 1 in one row of each text that has any."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = sent.value.head()
        for b in batches:
            done = 0
            for texts in portions(b["text"], 4 << 20):
                text = coded(texts)
                tail = np.fromiter((w not in head for w in text.words.to_pylist()), bool, len(text.words))
                at = np.flatnonzero(tail[text.codes])
                # The words of a text in one number with the text's own, which comes first.
                each, n = np.unique(
                    np.searchsorted(text.ends, at) * len(text.words) + text.codes[at], return_counts=True
                )
                rows, word = np.divmod(each, len(text.words))
                first = np.diff(rows, prepend=-1) > 0
                of = pa.array(rows + done)
                done += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        text.words.take(pa.array(word)), b["doc_id"].take(of), b["crc"].take(of),
                        pa.array(n, pa.int64()), pa.array(first.astype(np.int64)),
                    ],
                    names=["word", "doc_id", "crc", "n", "first"],
                )

    return docs.mapInArrow(run, "word binary, doc_id long, crc long, n long, first long")


def score(docs: DataFrame, **cols: str) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, false_hits``.

    Learns from all rows that are not held out and scores all rows. Null and empty texts are one
    end token; null ids are held out and stay null; repeated rows each give a row and each count
    in training; other columns are not read. Without training rows every token is unknown.
    """
    d = id_and_text(docs, **cols).select(
        "doc_id", F.crc32(F.col("text").cast("binary")).alias("crc"), held_out(F.col("doc_id")).alias("held_out"), "text"
    )
    train = d.where("NOT held_out").select("text")
    # Distinct pairs are counted before the rare ones go.
    seen = Observation()
    counted = _counts(train).observe(seen, F.count("pair").alias("pairs"))
    counted = written(counted.where(F.col("word").isNotNull() | (F.col("n") >= LEAST_PAIR)), "lm-counts", "zstd")
    pairs = seen.get["pairs"]
    counts = counted.where("word IS NOT NULL").select("word", "n")
    size = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n, v = size["n"] or 0, size["v"]
    head = counts.orderBy(F.desc("n"), "word").limit(HEAD_WORDS).toArrow()
    head = b"\n".join(head["word"].to_pylist()), head["n"].to_numpy()
    log_filter = build_filter(counts, counted.where("pair IS NOT NULL").select("pair", "n"))
    weight = min(max(1 - pairs / max(n, 1), 0.0), 0.9)
    sent = docs.sparkSession.sparkContext.broadcast(LanguageModel(*head, n, v, weight))
    # Words that are not in the head meet their exact counts by a join.
    tail = _tail(d, sent).join(counts.withColumnRenamed("n", "c"), "word", "left")
    found = F.coalesce("c", F.lit(0))
    tail = tail.groupBy(F.col("doc_id").alias("t_doc_id"), F.col("crc").alias("t_crc")).agg(
        F.sum(F.when(found > 0, F.col("n")).otherwise(0)).alias("known"),
        F.sum(F.col("n") * F.log10(found + 1.0)).alias("log"),
        F.sum("first").alias("rows"),
    )
    # Written, so that its shuffle need not be kept beside that of the chunks.
    tail = written(tail, "lm-tail")
    scored = _scored(log_filter.probed(_dealt(d, sent, log_filter.shards)), sent, log_filter.shards)
    same = F.col("doc_id").eqNullSafe(F.col("t_doc_id")) & (F.col("crc") == F.col("t_crc"))
    out = scored.join(tail, same, "left")
    # Equal rows have sent their words once each.
    known = F.coalesce(F.col("known") / F.col("rows"), F.lit(0)).cast("bigint")
    logs = F.col("head_log") + F.coalesce(F.col("log") / F.col("rows"), F.lit(0.0))
    all_tokens = F.log10(F.lit(float(n + v + 1)))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + known).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (logs - F.col("n_tokens") * all_tokens).alias("base_score"),
        "score",
        F.lit(log_filter.false_hits()).alias("false_hits"),
    )
