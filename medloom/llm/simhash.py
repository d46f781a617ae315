"""SimHash fingerprints of documents."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from medloom.llm._common import carried_type, id_and_text

UPPER_TO_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
SEED = 42
# Shingles whose bits are counted at once.
CHUNK = 1 << 15


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of each shingle of ``size`` words, as unsigned 64-bit integers."""
    from xxhash import xxh64_intdigest

    words = text.encode().translate(UPPER_TO_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    starts = list(accumulate(map(len, words), lambda at, n: at + n + 1, initial=0))
    if len(words) <= size:
        return np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    hashes = [xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[size:])]
    return np.array(hashes, np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of the hashes; zero without hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[at : at + CHUNK].astype("<u8").view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int, carry: Sequence[str] = (), **cols: str) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (the 64 bits as a signed long), a row per input row; columns
    named in ``carry`` come along in the struct ``carried``."""
    d = id_and_text(docs, carry=carry, **cols)
    more = d.columns[2:]
    names = ["doc_id", "fingerprint", *more]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(shingle_hashes(t.as_py(), shingle_words)) for t in batch["text"]]
            signed = pa.array(np.array(prints, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], signed, *(batch[c] for c in more)], names=names)

    return d.mapInArrow(run, "doc_id long, fingerprint long" + carried_type(d))
