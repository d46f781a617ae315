"""Toxicity of texts after noisy-channel deobfuscation.

Disguised words (leetspeak, letters set apart, letters repeated) become lattices of the characters
they may stand for; a Viterbi search finds the likeliest word under a character language model
and the cost of each disguise. The restored text is scored by the words and word beginnings that
mark toxic documents among the labelled ones.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.llm._common import id_and_text, written
from medloom.session import sized

# A marker is in at least so many of the toxic documents it is fitted on.
MARKER_DOCUMENTS = 6
# Log of how many times likelier a marker is in toxic than in clean documents, at least.
LEAST_GAIN = 2.8
# Markers this likely and in this share of the toxic documents are evidence in any case.
PLAIN_GAIN = 4.0
PLAIN_SHARE = 0.02
# Any other marker adds at least this share of the toxic documents.
LEAST_SHARE = 0.005
# Word beginnings that are tried as markers.
BEGINNINGS = range(4, 9)
TOXIC_SCORE = 0.5

# Up to this many labels are broadcast (some tens of MB).
BROADCAST_LABELS = 2_000_000

MEMO_ENTRIES = 400_000
# Distinct words or markers a task counts before it hands them on.
FLUSH_WORDS = 200_000
# Longer words are restored anew each time they come, so that the memo stays small.
MEMO_CHARS = 48

# What a sign may stand for inside a word.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou", "#": "h",
}
SIGNS = "".join(STANDS_FOR)
# Log costs: of a sign standing for a letter, of dropping a repeated letter, of dropping a sign.
SIGN_COST = -0.5
REPEAT_COST = -0.3
DROP_COST = -9.0
# Log cost of a word end between letters that are set apart.
BREAK_COST = -1.0
# State of a path that has ended a word and not begun another; its first two signs are its context.
AFTER_END = "^^|"

_EDGE = re.compile(r"^[^\w@$!|+(€£*#]+|[^\w@$|+*]+$")
_LETTER = r"[^\W\d_]"
_SIGN = f"[{re.escape(SIGNS)}]"
# A word with a sign next to letters, or a letter three times running.
_DISGUISED = re.compile(f"{_LETTER}{_SIGN}|{_SIGN}{_LETTER}|({_LETTER})\\1\\1")
# Four or more single letters or signs, set apart by one and the same separator.
_APART = re.compile(rf"(?<![\w@$])(?:{_LETTER}|{_SIGN})([ .\-_*])(?:{_LETTER}|{_SIGN})(?:\1(?:{_LETTER}|{_SIGN})){{2,}}(?![\w@$])")


def gram_counts(words: dict[str, int]) -> Counter:
    """How often each run of one to three letters ends somewhere in the words, their marked starts
    (^) and ends ($) included."""
    counts = Counter()
    for word, n in words.items():
        padded = f"^^{word}$"
        for i in range(2, len(padded)):
            for size in (1, 2, 3):
                counts[padded[i - size + 1 : i + 1]] += n
    return counts


class CharModel(NamedTuple):
    """Letter trigrams with back-off to bigrams and single letters, as log probabilities."""

    grams: dict[str, float]
    floor: float

    @classmethod
    def of(cls, words: dict[str, int]) -> CharModel:
        return cls.of_grams(gram_counts(words))

    @classmethod
    def of_grams(cls, counts: dict[str, int]) -> CharModel:
        before = Counter()
        for gram, n in counts.items():
            before[gram[:-1], len(gram)] += n
        logs = {g: math.log(c / before[g[:-1], len(g)]) for g, c in counts.items()}
        return cls(logs, min(logs.values(), default=-10.0) - 2.0)

    def log_p(self, context: str, letter: str) -> float:
        grams = self.grams
        found = grams.get(context + letter)
        if found is None:
            found = grams.get(context[1:] + letter)
            if found is None:
                return grams.get(letter, self.floor) - 2.0
            return found - 1.0
        return found


def restore(word: str, model: CharModel, breaks: bool = False) -> str:
    """The likeliest word behind a disguised one (lower case). With ``breaks`` it may be several
    words, set apart by blanks: after each letter the path may end a word and begin another.

    Works along the runs of one character, so the time grows with the length of the word.
    """
    # Runs of one character: (character, length).
    runs: list[list] = []
    for c in word:
        if runs and runs[-1][0] == c:
            runs[-1][1] += 1
        else:
            runs.append([c, 1])
    # Best log probability of each state (the last two letters), and the steps that led there.
    paths: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}
    for c, length in runs:
        steps = [(letter * k, cost) for letter, cost in _readings(c) for k, cost in _copies(length, letter, cost)]
        following: dict[str, tuple[float, tuple | None]] = {}
        for context, (score, back) in paths.items():
            for out, cost in steps:
                state, p = context, score + cost
                for letter in out:
                    p += model.log_p(state[:2], letter)
                    state = state[1] + letter
                if state not in following or p > following[state][0]:
                    following[state] = (p, (back, out))
        if breaks:
            inside = [(s, p, back) for s, (p, back) in following.items() if s not in ("^^", AFTER_END)]
            ended = [(p + model.log_p(s, "$") + BREAK_COST, (back, " ")) for s, p, back in inside]
            best = max(ended, key=lambda e: e[0], default=None)
            if best and (AFTER_END not in following or best[0] > following[AFTER_END][0]):
                following[AFTER_END] = best
        paths = following
    ends = [(p if s == AFTER_END else p + model.log_p(s, "$"), back) for s, (p, back) in paths.items()]
    back, letters = max(ends, key=lambda e: e[0])[1], []
    while back:
        back, out = back
        letters.append(out)
    return "".join(reversed(letters)).strip()


def _readings(c: str) -> list[tuple[str, float]]:
    if c in STANDS_FOR:
        share = math.log(len(STANDS_FOR[c]))
        return [*((x, SIGN_COST - share) for x in STANDS_FOR[c]), ("", DROP_COST)]
    return [(c, 0.0)]


def _copies(length: int, letter: str, cost: float) -> list[tuple[int, float]]:
    """How many copies of a letter a run of it may stand for, with the cost of all."""
    if not letter or length == 1:
        return [(1, cost * length)]
    if length == 2:
        return [(2, 2 * cost), (1, 2 * cost + 5 * REPEAT_COST)]
    return [(k, cost * length + REPEAT_COST * (length - k)) for k in (1, 2)]


class Reader:
    """Words of texts after restoring, with a memo of what a word's markers are."""

    def __init__(self, model: CharModel, evidence: dict[str, float] | None = None):
        self.model, self.evidence = model, evidence or {}
        self.restored: dict[str, str] = {}
        self.memo: dict[str, float] = {}
        self.marks: dict[str, frozenset[str]] = {}

    def restored_word(self, word: str) -> str:
        """A word (lower case, as it stands between blanks) without its edges and disguise."""
        bare = _EDGE.sub("", word)
        if not _DISGUISED.search(bare):
            return bare.strip("@$!|+(€£*#_") if not bare.isalnum() else bare
        if len(bare) > MEMO_CHARS:
            return restore(bare, self.model)
        if bare not in self.restored:
            if len(self.restored) >= MEMO_ENTRIES // 8:
                self.restored.clear()
            self.restored[bare] = restore(bare, self.model)
        return self.restored[bare]

    def words_apart(self, text: str) -> list[set[str]]:
        """Of each run of letters set apart (in a lower-case text): the words in it, and all of it
        read as one word."""
        found = []
        for m in _APART.finditer(text):
            run = m[0][::2]
            found.append({*restore(run, self.model, breaks=True).split(" "), restore(run, self.model)})
        return found

    def words(self, text: str) -> set[str]:
        """Distinct words of the restored text."""
        text = text.lower()
        return {self.restored_word(w) for w in set(text.split())}.union(*self.words_apart(text))

    def markers(self, text: str, wanted: set[str] | None = None) -> set[str]:
        """Distinct (wanted) markers of the restored text. A reader is asked for one ``wanted`` only."""
        text = text.lower()
        memo, found = self.marks, set()
        # Whole sets of markers take more room than the few that are wanted.
        most = MEMO_ENTRIES // 8 if wanted is None else MEMO_ENTRIES
        for w in set(text.split()):
            own = memo.get(w)
            if own is None:
                own = self._wanted(self.restored_word(w), wanted)
                if len(w) <= MEMO_CHARS:
                    if len(memo) >= most:
                        memo.clear()
                    memo[w] = own
            if own:
                found |= own
        return found.union(*[self._wanted(w, wanted) for words in self.words_apart(text) for w in words])

    @staticmethod
    def _wanted(word: str, wanted: set[str] | None) -> frozenset[str]:
        own = markers(word)
        return frozenset(own if wanted is None else wanted.intersection(own))

    def log_odds(self, text: str) -> float:
        """Sum of the strongest pieces of evidence, one per word."""
        text = text.lower()
        memo, found = self.memo, []
        for w in set(text.split()):
            e = memo.get(w)
            if e is None:
                e = self._evidence(self.restored_word(w))
                if len(w) <= MEMO_CHARS:
                    if len(memo) >= MEMO_ENTRIES:
                        memo.clear()
                    memo[w] = e
            if e:
                found.append(e)
        for words in self.words_apart(text):
            found.append(max(map(self._evidence, words)))
        return sum(sorted(found, reverse=True)[:3])

    def _evidence(self, word: str) -> float:
        return max((self.evidence.get(m, 0.0) for m in markers(word)), default=0.0)


def markers(word: str) -> list[str]:
    """The word itself (with an end mark) and its beginnings."""
    return [word + "$", *(word[:k] for k in BEGINNINGS if k <= len(word))] if word else []


class ToxicityModel(NamedTuple):
    chars: CharModel
    evidence: dict[str, float]
    prior: float
    without: float  # log odds of a document without any evidence

    def reader(self) -> Reader:
        return Reader(self.chars, self.evidence)


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fits on all of ``labels`` (``doc_id, label``) and their texts in ``docs``."""
    labels = labels.where("doc_id IS NOT NULL AND label IN (0, 1)").distinct()
    # Shares of the classes among all labelled rows, with and without a text.
    sizes = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    # Of copies, one document is enough: texts that are equal but for case and white space. Texts are
    # hashed before the join and the chosen ones written, so that they travel once at most.
    plain = F.trim(F.regexp_replace(F.lower("text"), r"\s+", " "))
    hashed = docs.select("doc_id", F.xxhash64(plain).alias("copy"))
    copies = hashed.join(sized(labels, "toxic-labels", BROADCAST_LABELS), "doc_id")
    chosen = copies.groupBy("label", "copy").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "label").distinct()
    chosen = sized(chosen, "toxic-chosen", BROADCAST_LABELS)
    sample = written(docs.join(chosen, "doc_id").select("text", "label"), "toxic-sample")
    # Runs of at most three letters: bounded by the letters there are, whatever the texts.
    letters = sample.mapInArrow(_letters, "gram string, n long, label int, documents long")
    letters = letters.groupBy("gram", "label").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents")).collect()
    chars = CharModel.of_grams({r["gram"]: r["n"] for r in letters if r["gram"] is not None})
    n = {0: 0, 1: 0} | {r["label"]: r["documents"] for r in letters if r["gram"] is None}
    prior = (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)
    # A marker of fewer documents is never chosen below. So the markers that are tried are a bounded
    # number, whatever the corpus: a document's markers over ``LEAST_SHARE``.
    least = max(MARKER_DOCUMENTS, LEAST_SHARE * n[1])
    of_toxic = {r["marker"]: r["n"] for r in _marked(sample.where("label = 1"), chars).where(F.col("n") >= least).collect()}
    own = written(_own_markers(sample, chars, set(of_toxic)), "toxic-markers")
    clean = own.where("label = 0").select(F.explode("own").alias("marker")).groupBy("marker").count()
    of_clean = {r["marker"]: r["count"] for r in clean.collect()}
    gains = {}
    for marker, a in of_toxic.items():
        # Counts on the careful side: rare words agree by chance.
        gain = math.log((a - 2) / (n[1] + 1)) - math.log((of_clean.get(marker, 0) + 1) / (n[0] + 1))
        if gain > LEAST_GAIN:
            gains[marker] = min(gain, 8.0)
    shares = {m: of_clean.get(m, 0) / (n[0] + 1) for m in gains}
    plain = {m for m, gain in gains.items() if gain > PLAIN_GAIN and of_toxic[m] >= PLAIN_SHARE * n[1]}
    evidence = {m: gains[m] for m in plain | {*_covering(own.where("label = 1"), plain, shares, n[1])}}
    odds = math.log(prior / (1 - prior))
    if not evidence:
        return ToxicityModel(chars, {}, prior, odds)
    bare = own.where(~F.arrays_overlap("own", _texts(evidence))).groupBy("label").count().collect()
    missed = {r["label"]: r["count"] for r in bare}
    without = [(missed.get(k, 0) + 0.5) / (n[k] + 1) for k in (1, 0)]
    return ToxicityModel(chars, evidence, prior, odds + math.log(without[0] / without[1]))


def _texts(markers: Iterable[str]) -> Column:
    """Markers (which hold no white space) as one constant."""
    return F.split(F.lit("\n".join(sorted(markers))), "\n")


def _covering(toxic: DataFrame, plain: set[str], clean_shares: dict[str, float], n: int) -> list[str]:
    """Further markers, chosen one by one for what each adds: toxic documents (of ``n``) that no earlier
    one is in, against its share of the clean ones. Words that only some copies of one document have
    add nothing once a common marker has covered these. At most 1 / ``LEAST_SHARE`` rounds."""
    known = F.array_intersect("own", _texts(clean_shares))
    left = toxic.where(~F.arrays_overlap("own", _texts(plain))).select(known.alias("own"))
    # Documents with the same markers go on as one row.
    left = written(left.where(F.size("own") > 0).groupBy("own").agg(F.count("*").alias("n")), "toxic-open")
    chosen, least = [], max(MARKER_DOCUMENTS, LEAST_SHARE * n)
    while True:
        open_ = left.where(~F.arrays_overlap("own", _texts(chosen)))
        counts = open_.select(F.explode("own").alias("marker"), "n").groupBy("marker").agg(F.sum("n").alias("n"))
        # At most as many as there are gains.
        covered = {r["marker"]: r["n"] for r in counts.where(F.col("n") >= (MARKER_DOCUMENTS if chosen else 1)).collect()}
        best = max(covered, key=lambda m: (covered[m] / n - clean_shares[m], -len(covered), m), default=None)
        if best is None or covered[best] < least:
            return chosen
        chosen.append(best)


def _own_markers(sample: DataFrame, chars: CharModel, wanted: set[str]) -> DataFrame:
    """``label, own``: the wanted markers of each document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(chars)
        for batch in batches:
            own = [sorted(reader.markers(t.as_py(), wanted)) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["label"], pa.array(own, pa.list_(pa.string()))], names=["label", "own"])

    return sample.mapInArrow(run, "label int, own array<string>")


def _letters(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the letter runs of a task's plain words, and (without a run) its documents by label."""
    words, documents = Counter(), Counter()

    def rows(grams: list, n: list[int], labels: list, counts: list) -> pa.RecordBatch:
        columns = [pa.array(grams, pa.string()), pa.array(n, pa.int64()), pa.array(labels, pa.int32()), pa.array(counts, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["gram", "n", "label", "documents"])

    def grams() -> pa.RecordBatch:
        bare = Counter()
        for word, n in words.items():
            bare[_EDGE.sub("", word)] += n
        counts = gram_counts({w: n for w, n in bare.items() if w.isalpha()})
        words.clear()
        return rows(list(counts), list(counts.values()), [None] * len(counts), [0] * len(counts))

    for batch in batches:
        documents.update(batch["label"].to_pylist())
        for text in batch["text"]:
            words.update(set(text.as_py().lower().split()))
        if len(words) >= FLUSH_WORDS:
            yield grams()
    yield grams()
    yield rows([None] * len(documents), [0] * len(documents), list(documents), list(documents.values()))


def _marked(sample: DataFrame, chars: CharModel) -> DataFrame:
    """``marker, n``: in how many documents each marker is."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, counts = Reader(chars), Counter()

        def rows() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, names=["marker", "n"])

        for batch in batches:
            for text in batch["text"]:
                counts.update(reader.markers(text.as_py()))
                if len(counts) >= FLUSH_WORDS:
                    yield rows()
        yield rows()

    return sample.mapInArrow(run, "marker string, n long").groupBy("marker").agg(F.sum("n").alias("n"))


def held_out(doc_id: Column) -> Column:
    """Whether a document's label may not be learned from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = TOXIC_SCORE, **cols: str) -> DataFrame:
    """``doc_id, held_out, score, predicted``: a row per input row.

    The score is the probability of label ``toxic`` = 1. Labels that are null, neither 0 nor 1 or
    without a document are left aside. Without a toxic label to learn from each score is the
    share of label 1. Null and empty texts score as texts without evidence; a null id is held out;
    repeated rows each give a row; other columns are not read.
    """
    d = id_and_text(docs, **cols)
    own = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    model = fit(d, own.where(~held_out(F.col("doc_id"))))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded: letter runs, and markers of a least share
    fields = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        reader = m.reader()
        odds = math.log(m.prior / (1 - m.prior))
        for batch in batches:
            found = np.array([reader.log_odds(t.as_py()) for t in batch["text"]], float)
            score = 1 / (1 + np.exp(-np.where(found > 0, odds + found, m.without)))
            columns = [batch["doc_id"], batch["held_out"], pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, schema=fields)

    marked = d.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return marked.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
