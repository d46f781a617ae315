"""Line dedup over an index that can take documents in and out again.

The index is exact: a table of postings (key, document) and a reference count per key with the
document that keeps the key's lines. Beside it, one cuckoo filter per shard holds the keys that
have reached the threshold; documents probe the filters, and only what passes meets the exact
table. Keys that reach the threshold are inserted into the filters, keys that fall below it are
deleted, so taking a document out leaves the index as if it had never come.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.llm._common import BLANK_CHARS, carried_type, id_and_text, written

MIN_CHARS = 40
MIN_DOCS = 5
# Keys a shard's filter is laid out for; the number of shards follows the number of keys.
SHARD_KEYS = 1 << 16
# All filters together are broadcast up to this size; beyond it postings go to the exact join
# unfiltered, with the same result.
BROADCAST_BYTES = 64 << 20

UPPER_TO_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key may lie in either of two buckets."""

    SLOTS = 4
    MOVES = 500

    def __init__(self, keys: int = 0, table: np.ndarray | None = None):
        buckets = 1 << max(3, int(np.ceil(np.log2(max(keys, 1) / (self.SLOTS * 0.9)))))
        self.table = np.zeros((buckets, self.SLOTS), np.uint16) if table is None else table

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        return cls(table=np.frombuffer(raw, "<u2").reshape(-1, cls.SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        prints = (hashes >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        mask = np.uint64(len(self.table) - 1)
        first = hashes & mask
        return prints, first, (first ^ self._turn(prints)) & mask

    @staticmethod
    def _turn(prints: np.ndarray) -> np.ndarray:
        return prints.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(hashes)
        here = (self.table[first] == prints[:, None]) | (self.table[second] == prints[:, None])
        return here.any(axis=1)

    def insert(self, hashes: np.ndarray) -> bool:
        """Inserts distinct keys; False if one found no place (lay the filter out larger then)."""
        mask = len(self.table) - 1
        for fp, *places in zip(*self._places(hashes)):
            for at in places:
                free = np.flatnonzero(self.table[at] == 0)
                if len(free):
                    self.table[at, free[0]] = fp
                    break
            else:
                at = int(places[1])
                for move in range(self.MOVES):
                    slot = move % self.SLOTS
                    fp, self.table[at, slot] = self.table[at, slot].copy(), fp
                    at = (at ^ int(self._turn(np.array([fp], np.uint16))[0])) & mask
                    free = np.flatnonzero(self.table[at] == 0)
                    if len(free):
                        self.table[at, free[0]] = fp
                        break
                else:
                    return False
        return True

    def delete(self, hashes: np.ndarray) -> None:
        """Deletes keys that were inserted before."""
        for fp, *places in zip(*self._places(hashes)):
            for at in places:
                held = np.flatnonzero(self.table[at] == fp)
                if len(held):
                    self.table[at, held[0]] = 0
                    break

    @classmethod
    def holding(cls, hashes: np.ndarray) -> CuckooFilter:
        keys = len(hashes)
        while not (made := cls(keys)).insert(hashes):
            keys = 2 * max(keys, 8)
        return made


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """128-bit key of a line: ends stripped, A-Z lower-cased; None if it is shorter."""
    line = line.strip(BLANK_CHARS)
    if len(line) < min_chars:
        return None
    return hashlib.blake2b(line.encode().translate(UPPER_TO_LOWER), digest_size=16).digest()


def postings(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, key``: the distinct keys of each document. A hot key stays spread by document."""
    fields = pa.schema([("doc_id", pa.int64()), ("key", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                own = {line_key(x, min_chars) for x in text.as_py().split("\n")} - {None}
                ids += [doc_id.as_py()] * len(own)
                keys += own
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], schema=fields)

    return docs.mapInArrow(run, "doc_id long, key binary").distinct()


class LineIndex:
    """Postings, reference counts and filters; each change gives a new index (tables are written
    anew to the shared folder, so a lost executor or a failed job leaves the old one as it was)."""

    def __init__(self, refs: DataFrame, counts: DataFrame, filters: DataFrame, shards: int, min_chars: int, min_docs: int):
        self.refs, self.counts, self.filters = refs, counts, filters
        self.shards, self.min_chars, self.min_docs = shards, min_chars, min_docs

    @classmethod
    def build(cls, docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, **cols: str) -> LineIndex:
        refs = written(postings(id_and_text(docs, **cols), min_chars), "line-refs")
        counts = written(_counted(refs), "line-counts")
        live = counts.where(F.col("n_docs") >= min_docs)
        shards = max(1, -(-live.count() // SHARD_KEYS))
        changed = live.select("key", F.lit(True).alias("enters"))
        filters = written(_changed(None, changed, shards), "line-filters")
        return cls(refs, counts, filters, shards, min_chars, min_docs)

    def insert(self, docs: DataFrame, **cols: str) -> LineIndex:
        """The index with further documents; postings that it has already count once."""
        new = postings(id_and_text(docs, **cols), self.min_chars)
        known = self.refs.select(F.col("doc_id").alias("known_id"), F.col("key").alias("known_key"))
        new = new.join(known, new.doc_id.eqNullSafe(known.known_id) & (new.key == known.known_key), "left_anti")
        return self._next(self.refs.unionByName(new))

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """The index without the documents of the column ``doc_id``."""
        gone = doc_ids.select(F.col("doc_id").cast("bigint").alias("gone_id")).distinct()
        return self._next(self.refs.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")), "left_anti"))

    def _next(self, refs: DataFrame) -> LineIndex:
        refs = written(refs, "line-refs")
        counts = written(_counted(refs), "line-counts")
        was, now = (t.where(F.col("n_docs") >= self.min_docs).select("key") for t in (self.counts, counts))
        both = now.withColumn("now", F.lit(True)).join(was.withColumn("was", F.lit(True)), "key", "full")
        # Null for keys that stay: a filter that has grown full is laid out anew from these as well.
        enters = F.when(F.col("was").isNull(), F.lit(True)).when(F.col("now").isNull(), F.lit(False))
        filters = written(_changed(self.filters, both.select("key", enters.alias("enters")), self.shards), "line-filters")
        return LineIndex(refs, counts, filters, self.shards, self.min_chars, self.min_docs)

    def dropped(self) -> DataFrame:
        """``doc_id, key``: keys whose lines a document loses."""
        live = self.counts.where(F.col("n_docs") >= self.min_docs).select("key", "keeper")
        maybe = self._passing(self.refs)
        return maybe.join(live, "key").where(~F.col("doc_id").eqNullSafe(F.col("keeper"))).select("doc_id", "key")

    def _passing(self, refs: DataFrame) -> DataFrame:
        """The postings whose key a filter may hold; all of them if the filters are too large."""
        size = self.filters.agg(F.sum(F.length("filter"))).first()[0] or 0
        if size > BROADCAST_BYTES:
            return refs
        held = self.filters.collect()  # at most BROADCAST_BYTES
        sent = refs.sparkSession.sparkContext.broadcast({r["shard"]: bytes(r["filter"]) for r in held})
        shards = self.shards

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filters = {k: CuckooFilter.from_bytes(raw) for k, raw in sent.value.items()}
            for batch in batches:
                hashes, shard = _hashed(batch["key"].to_pylist(), shards)
                keep = np.zeros(len(hashes), bool)
                for k in np.unique(shard):
                    if k in filters:
                        own = np.flatnonzero(shard == k)
                        keep[own] = filters[k].contains(hashes[own])
                yield batch.filter(pa.array(keep))

        return refs.select("doc_id", "key").mapInArrow(run, "doc_id long, key binary")


def _hashed(keys: list[bytes], shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The 64 bits that a filter sees of each key, and its shard from the other half."""
    halves = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
    return halves[:, 0].copy(), (halves[:, 1] % np.uint64(shards)).astype(np.int64)


def _counted(refs: DataFrame) -> DataFrame:
    """Reference count and keeping document (largest id) of each key."""
    return refs.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))


def _changed(filters: DataFrame | None, changes: DataFrame, shards: int) -> DataFrame:
    """Filters after keys entered (true), left (false) or stayed (null), one row per shard. Keys lie
    evenly over the shards."""
    sharding = pa.schema([("shard", pa.int64()), ("hash", pa.int64()), ("enters", pa.bool_())])

    def shard_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, shard = _hashed(batch["key"].to_pylist(), shards)
            columns = [pa.array(shard), pa.array(hashes.view(np.int64)), batch["enters"]]
            yield pa.RecordBatch.from_arrays(columns, schema=sharding)

    keyed = changes.mapInArrow(shard_of, "shard long, hash long, enters boolean")

    def made(key: tuple, old: pa.Table, new: pa.Table) -> pa.Table:
        hashes = new["hash"].to_numpy().view(np.uint64)
        enters = np.array([-1 if x is None else int(x) for x in new["enters"].to_pylist()])
        n = int((enters != 0).sum())
        cuckoo = None
        if len(old):
            cuckoo = CuckooFilter.from_bytes(old["filter"][0].as_py())
            cuckoo.delete(hashes[enters == 0])
            if not cuckoo.insert(hashes[enters == 1]):
                cuckoo = None
        if cuckoo is None:
            cuckoo = CuckooFilter.holding(hashes[enters != 0])
        return pa.table({"shard": [key[0].as_py()], "n_keys": [n], "filter": [cuckoo.to_bytes()]})

    schema = "shard long, n_keys long, filter binary"
    spark = changes.sparkSession
    old = filters if filters is not None else spark.createDataFrame([], schema)
    return old.groupBy("shard").cogroup(keyed.groupBy("shard")).applyInArrow(made, schema)


def dedup_lines(docs: DataFrame, index: LineIndex, carry: Sequence[str] = (), **cols: str) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped``: each document without the lines the index drops.

    Lines are cut at \\n; null and empty texts are one empty line. A line shorter than the index's
    ``min_chars`` always stays. All lines of a key in one document stay or go together; the
    largest id that holds a key keeps them, and a null id counts as smaller than any other (as the
    keeper if all are null). Rows that repeat an id count as one document. Of the other columns
    those named in ``carry`` come along in the struct ``carried``; no input gives no rows.
    """
    d = id_and_text(docs, carry=carry, **cols)
    gone = index.dropped().groupBy(F.col("doc_id").alias("gone_id")).agg(F.collect_list("key").alias("gone"))
    joined = d.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")), "left").select(*d.columns, "gone")
    schema = "doc_id long, text string, n_lines long, n_dropped long" + carried_type(d)
    names, more = ["doc_id", "text", "n_lines", "n_dropped", *d.columns[2:]], d.columns[2:]
    min_chars = index.min_chars

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, dropped = [], [], []
            for text, gone in zip(batch["text"], batch["gone"]):
                text = text.as_py()
                lines = kept = text.split("\n")
                if gone.is_valid:
                    keys = set(gone.as_py())
                    kept = [x for x in lines if line_key(x, min_chars) not in keys]
                    text = "\n".join(kept)
                texts.append(text)
                counts.append(len(lines))
                dropped.append(len(lines) - len(kept))
            columns = [pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns, *(batch[c] for c in more)], names=names)

    return joined.mapInArrow(run, schema)


def digests(spark: SparkSession, docs: DataFrame, **cols: str) -> DataFrame:
    """Index all documents, drop the repeated lines, and give counts and hashes of what stays."""
    kept = dedup_lines(docs, LineIndex.build(docs, **cols), **cols)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
    FROM documents),
keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
live AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= {MIN_CHARS}
    GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
marked AS (
    SELECT k.*, live.keeper IS NOT NULL AND live.keeper <> k.doc_id AS gone
    FROM keyed AS k LEFT JOIN live USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""
