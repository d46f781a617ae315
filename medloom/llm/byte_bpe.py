"""Byte-level BPE through a sentencepiece model made straight from a rank vocabulary.

Each token of the vocabulary becomes a piece whose bytes are mapped to printable characters, with
the negative rank as its score, so sentencepiece merges in rank order. The normalizer is the
identity. Pre-tokens are encoded one by one; decoding maps ids back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from medloom.llm._common import id_and_text, portions

# Words kept in a worker's memo, with their ids; when full it starts anew.
MEMO_ENTRIES = 400_000
# Longer words are encoded each time instead of being kept.
MEMO_CHARS = 64


def read_ranks(path: str) -> list[bytes]:
    """Tokens in rank order from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it has one, else one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _message(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def model_proto(tokens: list[bytes]) -> bytes:
    """A serialized sentencepiece model; piece ids are ranks, the unknown piece comes last."""
    chars = byte_characters()
    normal, unknown, bpe = 1, 2, 2
    pieces = [("".join(chars[b] for b in t), -float(rank), normal) for rank, t in enumerate(tokens)]
    pieces.append(("<unk>", 0.0, unknown))
    out = bytearray()
    for text, score, kind in pieces:
        body = _message(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind)
        out += _message(1, body)
    # Trainer settings: the kind of model and where the special pieces are (none but unknown).
    absent = (1 << 64) - 1
    trainer = _number(3, bpe) + _number(4, len(pieces)) + _number(40, len(tokens))
    out += _message(2, trainer + b"".join(_number(field, absent) for field in (41, 42, 43)))
    # Normalizer: identity, no added, removed or escaped white space.
    out += _message(3, _message(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0))
    return bytes(out)


class Codec:
    """Encodes and decodes texts on a worker."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self.tokens = tokens
        self.whole = {t: rank for rank, t in enumerate(tokens)}
        self.chars = byte_characters()
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model_proto(tokens))
        self.split = regex.compile(pattern).findall
        # Ids of what stands between two single spaces, with the space before it.
        self.memo: dict[str, bytes | None] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers.

        A pre-token never goes on behind a space, and one that starts with a space starts there.
        So a text may be cut before each space that has no white space on either side.
        """
        cuts = [t.split(" ") for t in texts]
        new = set().union(*cuts).difference(self.memo)
        if len(self.memo) + len(new) > MEMO_ENTRIES:
            self.memo.clear()
            new = set().union(*cuts)
        cuttable = {p: self.split(" " + p) for p in new if p and not (p[0].isspace() or p[-1].isspace())}
        firsts = [self.split(c[0]) for c in cuts]
        known = self._merged(set().union(*cuttable.values(), *firsts))
        for p, pre_tokens in cuttable.items():
            self.memo[p] = b"".join([known[x] for x in pre_tokens])
        out = []
        for text, first, (_, *parts) in zip(texts, firsts, cuts):
            ids = [self.memo.get(p) for p in parts]
            if None in ids or text[:1] == " " or (parts and first and first[-1][-1:].isspace()):
                whole = self.split(text)
                lacks = set(whole).difference(known)
                known.update(self._merged(lacks))
                out.append(b"".join([known[x] for x in whole]))
            else:
                out.append(b"".join([known[x] for x in first] + ids))
        for p in new:
            if len(p) > MEMO_CHARS:
                self.memo.pop(p, None)
        return out

    def _merged(self, pre_tokens: set[str]) -> dict[str, bytes]:
        """Ids of pre-tokens."""
        found, merged = {}, []
        for p in pre_tokens:
            rank = self.whole.get(p.encode())  # a token of its own, even if no merges lead to it
            if rank is None:
                merged.append(p)
            else:
                found[p] = struct.pack("<I", rank)
        chars = self.chars
        mapped = ["".join([chars[b] for b in p.encode()]) for p in merged]
        for p, ids in zip(merged, self.pieces.encode(mapped, num_threads=1)):
            found[p] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(packed).cast("I")))


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, **cols: str) -> DataFrame:
    """``doc_id``, ``ids`` (binary, unsigned 32-bit) and ``decoded`` (binary), a row per input row.

    Null and empty texts give no ids; null ids stay null; repeated rows each give a row; other
    columns are not read. ``vocabulary`` is read once on the driver and sent to the workers: its
    size is that of the tokenizer, whatever the input.
    """
    return _mapped(docs, vocabulary, pattern, "doc_id long, ids binary, decoded binary", _both, cols)


def digests(docs: DataFrame, vocabulary: str, pattern: str, **cols: str) -> DataFrame:
    """``encode_documents`` as counts and hashes, made on the workers so that no ids travel."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _mapped(docs, vocabulary, pattern, schema, _digest, cols)


def _both(packed: bytes, decoded: bytes) -> tuple:
    return packed, decoded


def _digest(packed: bytes, decoded: bytes) -> tuple:
    return len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()


def _mapped(docs: DataFrame, vocabulary: str, pattern: str, schema: str, values, cols: dict) -> DataFrame:
    tokens = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = pa.schema([(name, types[kind]) for name, kind in (c.split() for c in schema.split(", "))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(tokens.value, pattern)
        for batch in batches:
            rows = []
            for texts in portions(batch["text"]):
                rows += [values(packed, codec.decode(packed)) for packed in codec.encode(texts)]
            made = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), list(fields)[1:])] if rows else []
            if rows:
                yield pa.RecordBatch.from_arrays([batch["doc_id"], *made], schema=fields)

    return id_and_text(docs, **cols).mapInArrow(run, schema)
