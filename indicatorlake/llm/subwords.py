"""Encoding and decoding with a SentencePiece vocabulary: Aho-Corasick matches drive a Viterbi pass."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .common import chunks, picked, ship

SPACE = "▁"
#: Encodings of words that a Python worker remembers, twice as many at most; longer words are always encoded anew.
REMEMBERED = 1 << 18
REMEMBERED_LENGTH = 48
#: A byte piece scores this much below the worst piece, as unknown characters do in unigram models.
UNKNOWN_PENALTY = 10.0

_loaded: dict[str, Pieces] = {}


class Pieces:
    """The pieces of a model file and the automaton over them."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.names = names
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.scores = {i: model.get_score(i) for i in plain}
        self.lengths = {i: len(names[i]) for i in plain}
        self.byte_score = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        # where no piece goes on past another character into a space mark, a text can be cut before each run of them
        self.cuttable = not any(SPACE in names[i].lstrip(SPACE) for i in plain)
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.remembered: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        self.texts: list[str | None] = [None] * size
        for i in plain:
            self.texts[i] = names[i]
        #: pieces of one character; every position begins with its own, so the automaton holds the longer ones only
        self.alone = {names[i]: (self.scores[i], i) for i in plain if self.lengths[i] == 1}
        longer = [i for i in plain if self.lengths[i] > 1]
        self.automaton = self._automaton(longer)
        # a piece that others spell with a better score is on no best path, so it need not be matched
        self.automaton = self._automaton([i for i in longer if self._total(self.best(names[i])) <= self.scores[i]])

    def _automaton(self, ids: list[int]) -> ahocorasick.Automaton:
        automaton = ahocorasick.Automaton()
        for i in ids:
            automaton.add_word(self.names[i], (self.lengths[i], self.scores[i], i))
        automaton.make_automaton()
        return automaton

    def _total(self, ids: array) -> float:
        return sum(self.scores.get(i, self.byte_score) for i in ids)

    def best(self, word: str) -> array:
        """Ids of the segmentation with the highest summed score; of equal ones that with the longer last piece.

        The automaton reports, position by position, every piece that ends there,
        longest first (its output links); each relaxes the best score of that
        position.  A position begins with its character as a piece of its own, or, if
        there is none, spelt in bytes, which is worse than any piece.
        """
        score, step = [0.0], [-1]
        for end, (length, value, i) in self.automaton.iter(word) if len(self.automaton) else ():
            while len(score) < end + 2:
                self._next(word, score, step)
            reached = score[end + 1 - length] + value
            if reached > score[end + 1] or reached == score[end + 1] and length > self.lengths.get(step[end + 1], 0):
                score[end + 1], step[end + 1] = reached, i
        while len(score) <= len(word):
            self._next(word, score, step)
        out, at = [], len(word)
        while at:
            i = step[at]
            if i < 0:
                out += [self.byte_ids[b] for b in reversed(word[at - 1].encode("utf-8", "surrogatepass"))]
                at -= 1
            else:
                out.append(i)
                at -= self.lengths[i]
        out.reverse()
        return array("i", out)

    def _next(self, word: str, score: list[float], step: list[int]) -> None:
        """Reach the next position by its character alone."""
        letter = word[len(score) - 1]
        value, i = self.alone.get(letter) or (self.byte_score * len(letter.encode("utf-8", "surrogatepass")), -1)
        score.append(score[-1] + value)
        step.append(i)

    def encoded(self, text: str) -> bytes:
        """Ids of a text as 32-bit numbers: a space mark before it and for every space in it; no text, no ids."""
        if not text:
            return b""
        marked = SPACE + text.replace(" ", SPACE)
        if not self.cuttable:
            return self.best(marked).tobytes()
        words, known = self.words.findall(marked), self.remembered
        parts = list(map(known.get, words))
        for k in [k for k, part in enumerate(parts) if part is None]:
            word = words[k]
            part = known.get(word) or self.earlier.get(word) or self.best(word).tobytes()
            if len(word) <= REMEMBERED_LENGTH:
                known[word] = part
            parts[k] = part
        if len(known) > REMEMBERED:  # words in use move on to the next generation, others are forgotten
            self.earlier, self.remembered = known, {}
        return b"".join(parts)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encoded(text), np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, bytes put together, space marks turned back, the first one dropped; unknown ids are nothing."""
        texts = self.texts
        try:
            joined = "".join(map(texts.__getitem__, ids))
        except (TypeError, IndexError):
            raw = bytearray()
            for i in ids:
                if i in self.byte_of:
                    raw.append(self.byte_of[i])
                elif 0 <= i < len(texts) and texts[i]:
                    raw += texts[i].encode("utf-8")
            joined = raw.decode("utf-8", "replace")
        joined = joined.replace(SPACE, " ")
        return joined[1:] if joined.startswith(" ") else joined


def pieces(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def encode(docs: DataFrame, keys: list[str], path: str, text: str = "text") -> DataFrame:
    """Keys, ``ids`` (array of int) and ``restored``: whether decoding the ids gives the text.

    ``path`` names the model file on every executor.  A null text has null ids and a
    null ``restored``; an empty one has no ids.  Texts that hold the space mark
    itself (U+2581) come back with spaces for it.  Each row is encoded alone and
    whole, without a shuffle.
    """
    ship(docs.sparkSession)
    plain, carried = picked(docs, keys, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            for part in chunks(batch, text):
                texts = part.column(text).to_pylist()
                found = [None if t is None else model.encoded(t) for t in texts]
                restored = [None if t is None else model.decode(np.frombuffer(ids, np.int32).tolist()) == t for t, ids in zip(texts, found)]
                ends = np.cumsum([0] + [len(ids or b"") // 4 for ids in found])
                flat = np.frombuffer(b"".join(ids for ids in found if ids), np.int32)
                offsets = pa.array([None if ids is None else int(e) for ids, e in zip(found, ends)] + [int(ends[-1])], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in keys] + [pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.array(restored, pa.bool_())],
                    [*keys, "ids", "restored"])

    return plain.mapInArrow(run, carried + "ids array<int>, restored boolean")


def decode(encoded: DataFrame, keys: list[str], path: str, ids: str = "ids") -> DataFrame:
    """Keys and ``text`` of rows with an array of ids; null ids give a null text, unknown ids nothing."""
    ship(encoded.sparkSession)
    plain, carried = picked(encoded, keys, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            texts = [None if i is None else model.decode([x for x in i if x is not None]) for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in keys] + [pa.array(texts, pa.string())], [*keys, "text"])

    return plain.mapInArrow(run, carried + "text string")
