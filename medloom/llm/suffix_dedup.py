"""Removal of repeated byte strings by bucket-pointer refinement.

The suffixes of all texts are put in buckets by their first q bytes. A bucket is refined by the
bucket identifiers of later offsets: the identifier at depth 2k of position p is made from those
at depth k of p and p + k, so each refinement reuses the one before, up to the full length. As
identifiers depend on content alone, a task refines its own texts, and only buckets travel.

Not every suffix needs to be sorted. Of the q-byte identifiers inside a string of the full length
the smallest one (leftmost among equals) is its anchor; equal strings have equal anchors in equal
places. Neighbouring strings with one anchor are a run, and a run is the unit that is dealt out:

1. Buckets of runs by the anchor's identifier. A bucket with one run holds nothing repeated.
2. A bucket whose runs all have the same content identifier is repeated as a whole.
3. In the other buckets, content identifiers that come twice are repeated as a whole; the strings
   of the other runs, and of one run of each repeated content, are compared by full identifiers.
   Only for these do bytes travel besides the texts themselves.

A key is an anchor identifier together with a content or string identifier: 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.llm._common import carried_type, id_and_text, written

LENGTH = 200
BUCKET_BYTES = 32
# Bytes refined at once; anchors are told apart by their place in such a piece.
PIECE = 1 << 17
_PLACE_BITS = 20
# Buckets with more contents to compare are dealt on in blocks of so many neighbouring strings.
CROWDED = 128
BLOCK = 8

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    z = x * _A
    z ^= z >> np.uint64(29)
    z += y
    z *= _B
    z ^= z >> np.uint64(32)
    return z


_BYTES = _mixed(np.arange(256, dtype=np.uint64) + np.uint64(1), np.arange(256, dtype=np.uint64) * _B)


def identifiers(data: np.ndarray, length: int, bucket_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket identifiers at depth ``bucket_bytes`` and ``length`` for each position that has them."""
    depth, ids, bucket = 1, _BYTES[data], None
    while True:
        if depth == bucket_bytes:
            bucket = ids
        if 2 * depth >= length:
            step = length - depth
            return bucket, _mixed(ids[: max(len(ids) - step, 0)], ids[step:])
        ids = _mixed(ids[: max(len(ids) - depth, 0)], ids[depth:])
        depth *= 2


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each ``width`` neighbours."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[: len(values) - (width - reach)], values[width - reach :]) if width > reach else values


def runs_of(data: np.ndarray, ends: list[tuple[int, int]], length: int, bucket_bytes: int) -> tuple[np.ndarray, ...]:
    """Start, number of strings, anchor and content identifier of each run.

    ``ends`` are the (start, end) of the texts in ``data``; no string crosses them.
    """
    none = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64))
    if len(data) < length:
        return none
    bucket, full = identifiers(data, length, bucket_bytes)
    place = np.uint64((1 << _PLACE_BITS) - 1)
    packed = (bucket & ~place) | np.arange(len(bucket), dtype=np.uint64)
    anchor = (_least(packed, length - bucket_bytes + 1) & place).astype(np.int64)
    inside = np.zeros(len(full), bool)
    for a, b in ends:
        inside[a : max(b - length + 1, a)] = True
    at = np.flatnonzero(inside)
    if not len(at):
        return none
    own = anchor[at]
    first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)]))
    count = np.diff(np.append(first, len(at)))
    start = at[first]
    content = _mixed(_mixed(full[start], full[start + count - 1]), count.astype(np.uint64))
    return start, count, bucket[own[first]], content


def _pieces(texts: Iterable[bytes], length: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """Texts joined into pieces, each with its (text number, offset in text, start, end).

    Cuts of long texts overlap by ``length - 1`` so that each string is in exactly one piece.
    """
    held, parts, size = [], [], 0
    for number, raw in enumerate(texts):
        for at in range(0, max(len(raw) - length + 1, 0), PIECE):
            part = raw[at : at + PIECE + length - 1]
            held.append(part)
            parts.append((number, at, size, size + len(part)))
            size += len(part)
            if size >= PIECE:
                yield np.frombuffer(b"".join(held), np.uint8), parts
                held, parts, size = [], [], 0
    if held:
        yield np.frombuffer(b"".join(held), np.uint8), parts


def _batch(fields: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)


_KEY = [("doc_id", pa.int64()), ("crc", pa.int64())]


def _runs(docs: DataFrame, length: int, bucket_bytes: int) -> DataFrame:
    """``doc_id, crc, start, strings, anchor, content`` of all runs."""
    names = ("start", "strings", "anchor", "content")
    fields = pa.schema(_KEY + [(n, pa.int32() if n in names[:2] else pa.int64()) for n in names])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, crcs = batch["doc_id"], batch["crc"]
            for data, parts in _pieces((t.as_buffer().to_pybytes() for t in batch["text"]), length):
                start, strings, anchor, content = runs_of(data, [p[2:] for p in parts], length, bucket_bytes)
                number, offset, begin, _ = np.array(parts, np.int64).T
                part = np.searchsorted(begin, start, "right") - 1
                of = pa.array(number[part])
                place = (start - begin[part] + offset[part]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(of), crcs.take(of), pa.array(place), pa.array(strings.astype(np.int32)),
                        pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)),
                    ],
                    schema=fields,
                )

    schema = "doc_id long, crc long, start int, strings int, anchor long, content long"
    return docs.mapInArrow(run, schema)


def _slices(listed: DataFrame, length: int, bucket_bytes: int) -> DataFrame:
    """``anchor, sub, doc_id, crc, start, strings, open, bytes`` of all runs to be compared.

    A crowded bucket is dealt on: its strings go in blocks of ``BLOCK`` offsets to the anchor, keyed
    by the bytes that all strings of the block share, which equal strings have in common.
    """
    fields = pa.schema(
        [("anchor", pa.int64()), ("sub", pa.int64()), *_KEY, ("start", pa.int32()), ("strings", pa.int32())]
        + [("open", pa.bool_()), ("bytes", pa.binary())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for doc_id, crc, packed, runs in zip(*[batch[c].to_pylist() for c in ("doc_id", "crc", "packed", "runs")]):
                raw = unpack(packed)
                for r in runs:
                    start, strings, anchor = r["start"], r["strings"], r["anchor"]
                    cut = raw[start : start + strings + length - 1]
                    if not r["crowded"]:
                        rows.append((anchor, 0, doc_id, crc, start, strings, not r["whole"], cut))
                        continue
                    for first, n, sub in _blocks(cut, strings, anchor, length, bucket_bytes):
                        own = cut[first : first + n + length - 1]
                        rows.append((anchor, sub, doc_id, crc, start + first, n, not r["whole"], own))
            for at in range(0, len(rows), 10_000):
                yield _batch(fields, *zip(*rows[at : at + 10_000]))

    schema = "anchor long, sub long, doc_id long, crc long, start int, strings int, open boolean, bytes binary"
    return listed.mapInArrow(run, schema)


def _blocks(cut: bytes, strings: int, anchor: int, length: int, bucket_bytes: int) -> Iterator[tuple[int, int, int]]:
    """(first string, strings, key of the shared bytes) of the blocks of a run."""
    bucket, _ = identifiers(np.frombuffer(cut, np.uint8), length, bucket_bytes)
    a = int(np.flatnonzero(bucket.view(np.int64) == anchor)[0])
    for k in range((a - strings + 1) // BLOCK, a // BLOCK + 1):
        first, last = max(a - k * BLOCK - BLOCK + 1, 0), min(a - k * BLOCK, strings - 1)
        shared = cut[a - k * BLOCK : a - k * BLOCK - BLOCK + 1 + length]
        key = hashlib.blake2b(shared, digest_size=8, salt=k.to_bytes(4, "little")).digest()
        yield first, last - first + 1, int.from_bytes(key, "little", signed=True)


def _compared(slices: DataFrame, length: int, bucket_bytes: int) -> DataFrame:
    """``doc_id, crc, first, last``: runs of repeated strings among the compared ones."""
    fields = pa.schema(_KEY + [("first", pa.int32()), ("last", pa.int32())])

    def found(rows: list[dict], buckets: list[int]) -> pa.RecordBatch:
        cuts = [r["bytes"] for r in rows]
        _, full = identifiers(np.frombuffer(b"".join(cuts), np.uint8), length, bucket_bytes)
        n = np.array([r["strings"] for r in rows])
        begin = np.cumsum([0, *map(len, cuts)])[:-1]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        row = np.repeat(np.arange(len(rows)), n)
        ids, bucket = full[begin[row] + within], np.array(buckets)[row]
        order = np.lexsort((ids, bucket))
        same = (ids[order][1:] == ids[order][:-1]) & (bucket[order][1:] == bucket[order][:-1])
        twice = np.zeros(len(ids), bool)
        twice[order] = np.append(same, False) | np.insert(same, 0, False)
        hit = np.flatnonzero(twice & np.array([r["open"] for r in rows])[row])
        first = np.flatnonzero(np.append(True, (np.diff(hit) != 1) | (np.diff(row[hit]) != 0))[: len(hit)])
        last = np.append(first[1:], len(hit)) - 1 if len(hit) else first
        at = np.array([r["start"] for r in rows])[row] + within
        of = [rows[k] for k in row[hit[first]]]
        return _batch(fields, [r["doc_id"] for r in of], [r["crc"] for r in of], at[hit[first]], at[hit[last]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, buckets, size, key, number = [], [], 0, None, 0
        for batch in batches:
            for r in batch.to_pylist():
                if (r["anchor"], r["sub"]) != key:
                    if size >= PIECE:
                        yield found(held, buckets)
                        held, buckets, size = [], [], 0
                    key, number = (r["anchor"], r["sub"]), number + 1
                held.append(r)
                buckets.append(number)
                size += len(r["bytes"])
        if held:
            yield found(held, buckets)

    dealt = slices.repartition("anchor", "sub").sortWithinPartitions("anchor", "sub")
    return dealt.mapInArrow(run, "doc_id long, crc long, first int, last int")


def _kept(marked: DataFrame, length: int, as_text: bool) -> DataFrame:
    more = [c for c in marked.columns if c == "carried"]
    schema = f"doc_id long, n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}"
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", *more]
    kinds = [pa.int64()] * 3 + [pa.string() if as_text else pa.binary()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for packed, runs in zip(batch["packed"], batch["runs"]):
                raw, runs = unpack(packed.as_py()), runs.as_py() or []
                start = np.array([r["first"] for r in runs], np.int64)
                end = np.array([r["last"] for r in runs], np.int64) + length
                kept, removed, spans = raw, 0, 0
                if len(start):
                    steps = np.bincount(start, minlength=len(raw) + 1) - np.bincount(end, minlength=len(raw) + 1)
                    gone = np.cumsum(steps)[:-1] > 0
                    removed = int(gone.sum())
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                rows.append((len(raw), removed, spans, kept.decode(errors="ignore") if as_text else kept))
            if rows:
                made = [pa.array(list(c), kind) for c, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([batch["doc_id"], *made, *(batch[c] for c in more)], names=names)

    return marked.mapInArrow(run, schema + carried_type(marked))


def _packed(docs: DataFrame) -> DataFrame:
    """Texts compressed for the shuffle."""
    more = [c for c in docs.columns if c == "carried"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed = pa.array([pack(t.as_buffer().to_pybytes()) for t in batch["text"]], pa.binary())
            columns = [batch["doc_id"], batch["crc"], packed, *(batch[c] for c in more)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "crc", "packed", *more])

    return docs.mapInArrow(run, "doc_id long, crc long, packed binary" + carried_type(docs))


def _by_document(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join by document; rows that share an id are told apart by the checksum of the text."""
    right = right.withColumnsRenamed({"doc_id": "r_doc_id", "crc": "r_crc"})
    same: Column = F.col("doc_id").eqNullSafe(F.col("r_doc_id")) & (F.col("crc") == F.col("r_crc"))
    return left.join(right, same, how).drop("r_doc_id", "r_crc")


def dedup_strings(
    docs: DataFrame,
    length: int = LENGTH,
    bucket_bytes: int = BUCKET_BYTES,
    carry: Sequence[str] = (),
    as_text: bool = False,
    **cols: str,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (binary): a row per input row.

    A text (null: empty) is its UTF-8 bytes. Each byte covered by a string of ``length`` bytes that
    also starts anywhere else, in the same or another row, is removed; strings never cross texts
    and are judged on the input. ``kept`` may cut characters; with ``as_text`` it is a string without
    the cut ones. Texts shorter than ``length`` stay whole; rows that repeat a row count as further
    places, so both lose what they share; null ids stay null; of the other columns those named in
    ``carry`` come along in the struct ``carried``; no input gives no rows.
    """
    if bucket_bytes & (bucket_bytes - 1) or not bucket_bytes < length:
        raise ValueError("bucket_bytes is a power of two below length")
    whole_rows = id_and_text(docs, carry=carry, **cols).withColumn("crc", F.crc32(F.col("text").cast("binary")))
    d = whole_rows.select("doc_id", "text", "crc")
    runs = _runs(d, length, bucket_bytes)

    # 1 and 2: buckets with more than one run. Counted before they travel, so a hot one is one row.
    buckets = runs.groupBy("anchor").agg(
        F.count("*").alias("n"), (F.min("content") != F.max("content")).alias("mixed")
    )
    # Written, so that the join shuffles both sides and a hot bucket can be split at run time.
    repeated = written(buckets.where("n > 1").select("anchor", "mixed"), "string-buckets")
    found = written(runs.join(repeated, "anchor"), "string-runs")

    # 3: content within mixed buckets.
    mixed = found.where("mixed")
    place = F.struct("doc_id", "crc", "start")
    contents = mixed.groupBy("anchor", "content").agg(F.count("*").alias("n"), F.min(place).alias("one"))
    contents = written(contents, "string-contents")
    crowded = contents.groupBy("anchor").count().where(F.col("count") > CROWDED)
    crowded = written(crowded.select("anchor", F.lit(True).alias("crowded")), "string-crowded")
    judged = mixed.join(contents, ["anchor", "content"]).select(
        "doc_id", "crc", "start", "strings", "anchor",
        (F.col("n") > 1).alias("whole"),
        ((F.col("n") == 1) | place.eqNullSafe(F.col("one"))).alias("compare"),
    )
    judged = written(judged, "string-judged")
    compared = judged.where("compare").join(crowded, "anchor", "left").withColumn("crowded", F.col("crowded").isNotNull())
    listed = compared.groupBy("doc_id", "crc").agg(
        F.collect_list(F.struct("start", "strings", "anchor", "whole", "crowded")).alias("runs")
    )
    slices = _slices(_by_document(_packed(d), listed, "inner"), length, bucket_bytes)
    partly = written(_compared(slices, length, bucket_bytes), "string-partly")

    last = (F.col("start") + F.col("strings") - 1).alias("last")
    whole = found.where("NOT mixed").unionByName(judged.where("whole"), allowMissingColumns=True)
    removed = whole.select("doc_id", "crc", F.col("start").alias("first"), last).union(partly)
    removed = removed.groupBy("doc_id", "crc").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    return _kept(_by_document(_packed(whole_rows), removed, "left"), length, as_text)


def digests(docs: DataFrame, **cols: str) -> DataFrame:
    """``dedup_strings`` with the hash of what is kept."""
    kept = dedup_strings(docs, **cols)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
