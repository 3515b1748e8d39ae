"""Token counts by rank-synchronous merging of pre-token arrays."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import chunks, picked, ship

LIMIT = 2048
#: Counts of pre-tokens that a Python worker remembers; when full it starts anew.
REMEMBERED = 1 << 20

_loaded: dict[str, Vocabulary] = {}


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 ones for themselves, the rest from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """Merge ranks and text rules of a byte-level BPE file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        end = model["end_of_word_suffix"] or ""
        ids = model["vocab"]
        letters = _byte_letters()
        self.inner = np.array([ids[c] for c in letters], np.int64)
        self.last = np.array([ids[c + end] for c in letters], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = np.array([ids[a] << 32 | ids[b] for a, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        order = np.argsort(pairs, kind="stable")
        self.pairs, self.ranks, self.made = pairs[order], order, made
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"].replace(r"[^\s", r"[^\p{White_Space}")
        self.pattern = regex.compile(pattern)
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]))
        self.counts: dict[str, int] = {}

    def pre_tokens(self, text: str) -> list[str]:
        """NFC, lower case letter by letter, cut by the file's pattern."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.pattern.findall(text.lower())

    def merged(self, words: list[bytes]) -> np.ndarray:
        """How many symbols of each word survive all merges.

        All words lie in one symbol array.  Each round finds every word's lowest
        merge rank and applies that pair at all its places, from the left where they
        overlap; words without a mergeable pair leave.
        """
        sizes = np.array([len(w) for w in words], np.int64)
        out = sizes.copy()
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(sizes)
        symbols[ends - 1] = self.last[raw[ends - 1]]
        owner = np.repeat(np.arange(len(words)), sizes)
        none = np.int64(len(self.pairs))
        while len(symbols) > 1:
            together = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.pairs, together), none - 1)
            rank = np.where((self.pairs[at] == together) & (owner[:-1] == owner[1:]), self.ranks[at], none)
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            padded = np.append(rank, none)
            lowest = np.minimum.reduceat(padded, first)
            runs = np.diff(np.append(first, len(symbols)))
            alive = np.repeat(lowest < none, runs)
            hit = (padded == np.repeat(lowest, runs)) & alive
            # of overlapping places (one letter repeated) every second is taken
            places = np.flatnonzero(hit)
            fresh = np.r_[True, np.diff(places) != 1]
            start = np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))
            places = places[(np.arange(len(places)) - start) % 2 == 0]
            symbols[places] = self.made[padded[places]]
            keep = alive
            keep[places + 1] = False
            out -= np.bincount(owner[places], minlength=len(out))
            symbols, owner = symbols[keep], owner[keep]
        return out

    def count(self, texts: list[str]) -> list[int]:
        tokens, extra = [], []
        for text in texts:
            parts = self.special.split(text)
            extra.append(len(parts) - 1)
            tokens.append(self.pre_tokens(parts[0]) if len(parts) == 1 else [t for p in parts for t in self.pre_tokens(p)])
        if len(self.counts) > REMEMBERED:
            self.counts.clear()
        new = list(set().union(*tokens).difference(self.counts))
        if new:
            self.counts.update(zip(new, self.merged([w.encode("utf-8", "surrogatepass") for w in new]).tolist()))
        known = self.counts.__getitem__
        return [sum(map(known, t)) + n for t, n in zip(tokens, extra)]


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def count_tokens(docs: DataFrame, keys: list[str], path: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """Keys, n_bytes, n_tokens and over_limit of every row.

    ``path`` names the vocabulary file on every executor.  A null or empty text has
    no bytes and no tokens; repeated rows are counted each; a text of any length is
    counted whole.  Each row is counted alone, without a shuffle.
    """
    ship(docs.sparkSession)
    plain, carried = picked(docs, keys, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for part in chunks(batch, text):
                texts = [t or "" for t in part.column(text).to_pylist()]
                counted = words.count(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in keys] + [
                        pa.array([len(t) if t.isascii() else len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                        pa.array(counted, pa.int64()), pa.array([n > limit for n in counted], pa.bool_())],
                    [*keys, "n_bytes", "n_tokens", "over_limit"])

    return plain.mapInArrow(run, carried + "n_bytes long, n_tokens long, over_limit boolean")
