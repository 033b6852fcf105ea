"""Substring removal by sliding sentence spans.

Texts are cut into sentences at . ! ? and newlines, and sentences of more than LONGEST words into parts
of LONGEST words, so that unpunctuated text has sentences too. Words are lower-cased runs of letters, digits
and underscores. Every run of SPAN consecutive sentences of a text is hashed; runs that occur again
in the corpus, the same text included, are joined globally by hash, and all sentences covered by any
but the first of them (least doc_id, then place) are removed.

Parts counted from a sentence's first word agree only if two copies start at the same word of their sentences, modulo
LONGEST. So sentences of more than LONG words are also cut where their content says so, which equal passages do alike
wherever they start, and runs of SPAN such parts are joined and removed in the same way, word by word.
A sentence that loses any word counts as removed from.

Defined cases: null and empty texts, and texts of fewer than SPAN sentences, are kept whole; texts of any
length are read whole; rows with equal id and text count as one text and are treated alike; null ids come last; an empty
table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import keyed_input, map_arrow, unkeyed, written
from .textcore import WORDISH, U, Block, blocks, constants, splitmix, words

SPAN = 3
LONGEST = 12
#: Sentences of more words, which hold a span by themselves, are cut at content-defined words as well, each the least of so
#: many words on both sides.
LONG, NEAR = SPAN * LONGEST, 3
#: A span has at most SPAN * LONGEST words.
SIZE_BITS = 6

_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n")] = True
_PLACE = constants(LONGEST, 5)


class Sentences:
    """Sentences of a block, as their first words, and its passages: the same text cut at content-defined words."""

    def __init__(self, b: Block):
        self.words = w = words(b, WORDISH)
        n = len(w.doc)
        self.first = np.zeros(0, np.int64)
        if not n:
            return
        ends = np.cumsum(_ENDS[b.data], dtype=np.int64)[w.start]
        self.new = np.concatenate([[True], (np.diff(ends) > 0) | (np.diff(w.doc) > 0)])
        self.first = self._parts(self.new)

    def _parts(self, new: np.ndarray) -> np.ndarray:
        """The first words of the parts of at most LONGEST words between words marked as new."""
        self.place = _since(new) % LONGEST
        return np.flatnonzero(self.place == 0)

    def _content(self) -> tuple[np.ndarray, np.ndarray]:
        """Words that begin a sentence or, in a sentence longer than LONG, whose pair with the next word has the least
        hash of all within NEAR words (of equal ones the leftmost); and the words of such sentences."""
        n, h = len(self.new), self.words.hash
        sentence = np.cumsum(self.new) - 1
        long = np.bincount(sentence)[sentence] > LONG
        v = np.full(n, ~U(0))
        inner = np.flatnonzero(~self.new[1:])
        v[inner] = splitmix(h[inner] * _PLACE[0] + h[inner + 1] * _PLACE[1])
        cut = long.copy()
        for d in range(1, min(NEAR + 1, n)):
            same = sentence[d:] == sentence[:-d]
            cut[d:] &= ~same | (v[d:] < v[:-d])
            cut[:-d] &= ~same | (v[:-d] <= v[d:])
        return self.new | cut, long

    def _runs(self, first: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, first words and numbers of words of the runs of SPAN parts within a row."""
        w = self.words
        part = np.add.reduceat(splitmix(w.hash * _PLACE[self.place]), first)
        doc, bounds = w.doc[first], np.append(first, len(w.doc))
        n = len(doc) - SPAN + 1
        at = np.flatnonzero(doc[: max(n, 0)] == doc[SPAN - 1 :]) if n > 0 else np.zeros(0, np.int64)
        h = np.full(len(at), U(salt))
        for j in range(SPAN):
            h = splitmix(h * U(0x9E3779B97F4A7C15) + part[at + j])
        return h, first[at], bounds[at + SPAN] - first[at]

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, first words and numbers of words of the runs of SPAN sentences, and of those of SPAN parts of passages
        that reach into a long sentence."""
        if not len(self.first):
            return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._parts(self.new)
        by_sentence = self._runs(self.first, 0)
        new, long = self._content()
        if not long.any():
            return by_sentence
        h, at, size = self._runs(self._parts(new), 1)
        c = np.concatenate([[0], np.cumsum(long)])
        some = c[at + size] > c[at]
        return tuple(np.concatenate([x, y[some]]) for x, y in zip(by_sentence, (h, at, size)))


def _since(new: np.ndarray) -> np.ndarray:
    """The number of words since the last new one."""
    first = np.flatnonzero(new)
    return np.arange(len(new)) - np.repeat(first, np.diff(np.append(first, len(new))))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, tag, places: the words (first << SIZE_BITS | number) of the spans of a text that are not the first of their
    kind. docs has doc_id, text and tag."""
    schema = pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("tag", pa.int64())])

    def make(batch):
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        tags = batch.column("tag").to_numpy(zero_copy_only=False)
        for b in blocks(batch.column("text"), lower=True):
            s = Sentences(b)
            h, at, size = s.spans()
            if not len(h):
                continue
            row = s.words.doc[at]
            place = at - np.searchsorted(s.words.doc, row)
            cols = [h.view(np.int64), ids[b.first + row], (place << SIZE_BITS) | size, tags[b.first + row]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=schema)

    spans = map_arrow(docs, make, "h long, doc_id long, at long, tag long")
    key = F.struct("doc_id", "at", "tag")
    again = spans.groupBy("h").agg(F.min(key).alias("first"), F.count("*").alias("n")).filter("n > 1")
    again = written(again, "span-again")  # a plain scan, so that a frequent span's rows can be split in the join
    later = spans.join(again, "h").filter(key > F.col("first"))
    return later.groupBy("doc_id", "tag").agg(F.collect_set("at").alias("places"))


def remove_spans(documents: DataFrame) -> DataFrame:
    """doc_id, n_sentences, n_removed (sentences that lose words) and kept (the text without the removed words) of every row."""
    docs = keyed_input(documents)
    found = written(repeated_spans(docs), "span-places")
    schema = pa.schema([("doc_id", pa.int64()), ("n_sentences", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def cut(batch):
        places = batch.column("places")
        parts = [[], [], []]
        for b in blocks(batch.column("text")):
            s = Sentences(_lowered(b))
            bounds = np.searchsorted(s.words.doc, np.arange(b.rows + 1))
            firsts = np.searchsorted(s.first, bounds)
            for i in range(b.rows):
                lo, hi = bounds[i], bounds[i + 1]
                text, n_removed = b.data[b.off[i] : b.off[i + 1]], 0
                if places[b.first + i].is_valid:
                    at = places[b.first + i].values.to_numpy(zero_copy_only=False)
                    place, size = at >> SIZE_BITS, at & ((1 << SIZE_BITS) - 1)
                    gone = _covered(hi - lo, place, place + size)
                    n_removed = int(np.logical_or.reduceat(gone, s.first[firsts[i] : firsts[i + 1]] - lo).sum())
                    # a word goes with what follows it up to the next one
                    start = np.append(s.words.start[lo:hi] - b.off[i], len(text))
                    text = text[~np.repeat(np.append(False, gone), np.diff(np.append(0, start)))]
                parts[0].append(firsts[i + 1] - firsts[i])
                parts[1].append(n_removed)
                parts[2].append(text.tobytes())
        cols = [pa.array(parts[0], pa.int64()), pa.array(parts[1], pa.int64()), pa.array(parts[2], pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], schema=schema)

    out = "doc_id long, n_sentences long, n_removed long, kept string"
    return unkeyed(map_arrow(docs.join(found, ["doc_id", "tag"], "left"), cut, out), "doc_id")


def _covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n places lie in some run."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, end, -1)
    return np.cumsum(edge[:-1]) > 0


_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[65:91] += 32


def _lowered(b: Block) -> Block:
    """Sentence bounds don't depend on case; ASCII folding keeps every byte in its place."""
    return Block(b.first, _ASCII_LOWER[b.data], b.off)
