"""Packing of tokenized documents into windows of fixed length with bounded space.

Each task keeps a fixed number of open windows. A piece goes to the window it fits best; when it
fits none and no further window may be opened, the fullest window takes as much of the piece as it
has room for and is emitted, and the rest of the piece is placed anew. At the end of a task its
open windows are merged into full ones and at most one rest; the rests of the tasks are merged in
a tree of fixed fan-in until one rest of less than a window is left in all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import filterfalse
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.llm._common import id_and_text, portions, written

WINDOW = 4096
OPEN_WINDOWS = 32
FAN_IN = 64
END_ID = 2

# Some 200 MB of short words and their ids.
MEMO_ENTRIES = 1_000_000
MEMO_CHARS = 64
# New words that are encoded as one text.
WORDS_AT_ONCE = 100
# Marks that the pre-tokenizer splits off a word they follow.
CLOSING = ".,;:!?"

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, part long, ids binary"
)
FIELDS = pa.schema(
    [(c.split()[0], {"long": pa.int64(), "binary": pa.binary()}[c.split()[1]]) for c in SCHEMA.split(", ")]
)


class WordTokenizer:
    """Ids of texts through a ``tokenizers`` model that never merges across white space."""

    def __init__(self, model_json: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model_json = model_json
        self.model = Tokenizer.from_str(model_json)
        self.model.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.model.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.memo = {"": b""}
        self.closing = dict(zip(CLOSING, self._each(list(CLOSING))))

    @classmethod
    def of_worker(cls, model_json: str) -> WordTokenizer:
        """The tokenizer of this Python worker, with the words that its earlier tasks have met."""
        import tokenizers

        held = getattr(tokenizers, "_words_of_worker", None)
        if held is None or held.model_json != model_json:
            held = tokenizers._words_of_worker = cls(model_json)
        return held

    def _each(self, texts: list[str]) -> list[bytes]:
        encoded = self.model.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only, encoded as one text and cut at the word ends."""
        if not words:
            return []
        encoded = self.model.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
        ids = np.array(encoded.ids, "<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return self._each(words)
        raw, ends = ids.tobytes(), (4 * ends).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cuts = [t.replace("\n", " ").replace("\t", " ").split(" ") for t in texts]
        new: set[str] = set()
        for parts in cuts:
            new.update(filterfalse(self.memo.__contains__, parts))
        if len(self.memo) + len(new) > MEMO_ENTRIES:
            self.memo = {"": b""}
            new = set().union(*cuts).difference(self.memo)
        closed = {p: p[:-1] for p in new if p[-1] in self.closing and p[:-1].isalpha()}
        plain = {p for p in new if p.isalpha()} | set(closed.values()).difference(self.memo)
        words = list(plain)
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = words[at : at + WORDS_AT_ONCE]
            self.memo.update(zip(some, self._words(some)))
        for p, word in closed.items():
            self.memo[p] = self.memo[word] + self.closing[p[-1]]
        others = list(new.difference(plain, closed))
        self.memo.update(zip(others, self._each(others)))
        out = [b"".join(map(self.memo.__getitem__, parts)) for parts in cuts]
        for p in new:
            if len(p) > MEMO_CHARS:
                del self.memo[p]
        return out


class Piece(NamedTuple):
    doc_id: int | None
    start: int
    ids: bytes
    doc_tokens: int

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[: 4 * at]), self._replace(start=self.start + at, ids=self.ids[4 * at :])


class Packer:
    """Open windows of one task; ``emit`` gets the pieces of each window that is closed."""

    def __init__(self, window: int, open_windows: int, emit):
        self.window, self.open_windows, self.emit = window, open_windows, emit
        self.open: list[tuple[int, list[Piece]]] = []  # (room left, pieces)

    def add(self, piece: Piece) -> None:
        while piece.length >= self.window:
            full, piece = piece.cut(self.window)
            self.emit([full])
        while piece.length:
            piece = self._place(piece)

    def _place(self, piece: Piece) -> Piece:
        """Places the piece or its head; returns what is left of it."""
        fits = [(room, k) for k, (room, _) in enumerate(self.open) if room >= piece.length]
        if fits:
            room, k = min(fits)
        elif len(self.open) < self.open_windows:
            room, k = self.window, len(self.open)
            self.open.append((room, []))
        else:
            room, k = min((room, k) for k, (room, _) in enumerate(self.open))
        head, rest = piece.cut(min(room, piece.length))
        pieces = [*self.open[k][1], head]
        if room == head.length:
            del self.open[k]
            self.emit(pieces)
        else:
            self.open[k] = (room - head.length, pieces)
        return rest

    def finish(self) -> list[Piece]:
        """Merges what is open into full windows; returns the rest, less than a window."""
        held, self.open = [p for _, pieces in sorted(self.open, key=lambda w: w[0]) for p in pieces], []
        rest, room = [], self.window
        for piece in held:
            while piece.length:
                head, piece = piece.cut(min(room, piece.length))
                rest.append(head)
                room -= head.length
                if not room:
                    self.emit(rest)
                    rest, room = [], self.window
        return rest


class _Rows:
    """Rows of emitted windows, numbered within one task or merged group."""

    def __init__(self, first_id: int, keep_ids: bool):
        self.next_id, self.keep_ids, self.rows = first_id, keep_ids, []

    def emit(self, pieces: list[Piece]) -> None:
        self._add(pieces, self.next_id, None, self.keep_ids)
        self.next_id += 1

    def rest(self, pieces: list[Piece], part: int) -> None:
        self._add(pieces, None, part, True)

    def _add(self, pieces, sequence, part, with_ids) -> None:
        at = 0
        for p in pieces:
            ids = p.ids if with_ids else None
            self.rows.append((p.doc_id, p.start, p.length, zlib.crc32(p.ids), p.doc_tokens, sequence, at, part, ids))
            at += p.length

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = zip(*rows) if rows else [[]] * len(FIELDS)
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, FIELDS)], schema=FIELDS)


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    end_id: int = END_ID,
    keep_ids: bool = False,
    **cols: str,
) -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``tokenizer`` is the path of a ``tokenizers`` file, read on the driver and sent to the workers.
    With ``keep_ids`` the ids of a piece come too (binary, unsigned 32-bit). A null or empty text
    is its end id alone; null ids stay null; repeated rows are packed each for itself; a text of
    any length is cut into windows; other columns are not read. No input gives no rows.

    Runs a job: the pieces are written once to the shared folder, because which window a piece is
    in must not change when a task is run again.
    """
    model = docs.sparkSession.sparkContext.broadcast(_read(tokenizer))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokenizer.of_worker(model.value)
        part = TaskContext.get().partitionId()
        out = _Rows(part << 32, keep_ids)
        packer = Packer(window, open_windows, out.emit)
        for batch in batches:
            ids_of = iter(batch["doc_id"].to_pylist())
            for texts in portions(batch["text"]):
                for ids in words.encode(texts):
                    ids += end
                    packer.add(Piece(next(ids_of), 0, ids, len(ids) // 4))
                yield out.take()
        out.rest(packer.finish(), part)
        yield out.take()

    packed = written(id_and_text(docs, **cols).mapInArrow(run, SCHEMA), "packed")
    done, rests, level = [packed.where("sequence_id IS NOT NULL")], packed.where("sequence_id IS NULL"), 0
    while True:
        most = rests.agg(F.max("part")).first()[0]
        if most is None:
            break
        level += 1
        last = most < FAN_IN
        merged = written(_merge(rests, level, last, window, keep_ids), f"packed-rests-{level}")
        done.append(merged.where("sequence_id IS NOT NULL"))
        rests = merged.where("sequence_id IS NULL")
        if last:
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*[c for c in out.columns if c != "part" and (keep_ids or c != "ids")])


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _merge(rests: DataFrame, level: int, last: bool, window: int, keep_ids: bool) -> DataFrame:
    """Merges up to ``FAN_IN`` rests of less than a window each; the last rest becomes a window."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("part", "ascending"), ("offset", "ascending")])
        number = group["part"][0].as_py() // FAN_IN
        out = _Rows((level << 56) + (number << 32), keep_ids)
        packer = Packer(window, 1, out.emit)
        for row in group.to_pylist():
            packer.add(Piece(row["doc_id"], row["start"], row["ids"], row["doc_tokens"]))
        rest = packer.finish()
        if rest and last:
            out.emit(rest)
        elif rest:
            out.rest(rest, number)
        return pa.Table.from_batches([out.take()])

    return rests.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(run, SCHEMA)
