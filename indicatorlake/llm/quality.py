"""Quality rules: how much of a text lies inside repeated word sequences and lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Words, chunks, folding, picked, repeated, ship, spans_hash, windows, words_of

#: n-gram length -> largest accepted share of the word characters inside n-grams that occur twice or more.
COVERAGE = {3: 0.35, 4: 0.30, 5: 0.25, 7: 0.22, 10: 0.20}
#: Largest accepted share of the word characters inside lines equal to an earlier line.
LINE_COVERAGE = 0.40
MIN_WORDS = 10
BASE_NGRAM = 5
BASE_SHARE = 20

_SYMBOL = folding(b"#*$%&|<>")
SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
          "line_coverage double, " + ", ".join(f"coverage_{n} double" for n in COVERAGE))


def _covered(words: Words, hashes: np.ndarray, n: int) -> np.ndarray:
    """Which words lie inside an n-gram that its text holds twice or more."""
    whole = words.same_text(n)
    at = np.flatnonzero(whole)
    keys = windows(hashes, n)[at] ^ (words.rows[at].astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    at = at[repeated(keys)]
    steps = np.zeros(len(hashes) + 1, np.int64)
    steps[at] += 1
    steps[at + n] -= 1
    return np.cumsum(steps[:-1]) > 0


def _line_repeats(words: Words, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every text: lines with a word that equal an earlier line, and the word characters in these."""
    data, offsets = words.data, words.offsets
    cuts = np.flatnonzero(data == 10)
    texts = len(offsets) - 1
    starts = np.concatenate([offsets[:-1], cuts + 1])
    ends_after = np.concatenate([cuts, offsets[1:]])
    # every text end and newline closes a line; the k-th start meets the k-th end once both are ordered within their text
    of_start = np.concatenate([np.arange(texts), np.searchsorted(offsets, cuts, "right") - 1])
    of_end = np.concatenate([np.searchsorted(offsets, cuts, "right") - 1, np.arange(texts)])
    starts, owner = starts[order := np.lexsort((starts, of_start))], of_start[order]
    ends = ends_after[np.lexsort((ends_after, of_end))]
    first = np.searchsorted(words.starts, starts)
    last = np.searchsorted(words.starts, ends)
    full = last > first
    starts, ends, owner, first, last = starts[full], ends[full], owner[full], first[full], last[full]
    keys = spans_hash(data, starts, ends) ^ (owner.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(keys), bool)
    again[order[1:]] = same
    raw = data.tobytes()
    for k, before in zip(order[1:][same].tolist(), order[:-1][same].tolist()):
        if raw[starts[k] : ends[k]] != raw[starts[before] : ends[before]]:  # equal in hash only: by content then
            seen = {raw[starts[j] : ends[j]] for j in range(k) if owner[j] == owner[k]}
            again[k] = raw[starts[k] : ends[k]] in seen
    sums = np.zeros(len(chars) + 1, np.int64)
    np.cumsum(chars, out=sums[1:])
    inside = (sums[last] - sums[first])[again]
    return (np.bincount(owner[again], minlength=texts),
            np.bincount(owner[again], weights=inside, minlength=texts))


def _measured(texts: pa.Array) -> dict[str, np.ndarray]:
    words = words_of(texts)
    hashes = words.hashes()
    points = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum((words.data & 0xC0) != 0x80, out=points[1:])
    symbols = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum(_SYMBOL[words.data], out=symbols[1:])
    chars = points[words.ends] - points[words.starts]
    out = {
        "n_words": np.diff(words.bounds),
        "word_chars": words.per_row(chars),
        "n_symbols": np.diff(symbols[words.offsets]),
    }
    total = np.maximum(out["word_chars"], 1)
    repeats, line_chars = _line_repeats(words, chars)
    covered = {n: _covered(words, hashes, n) for n in {*COVERAGE, BASE_NGRAM}}
    out["n_dup_lines"] = repeats
    out["n_repeat_words"] = words.per_row(covered[BASE_NGRAM])
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > BASE_SHARE * out["n_words"])
    shares = {n: words.per_row(covered[n] * chars) / total for n in COVERAGE}
    lines = line_chars / total
    kept = ~out["base_failed"] & (lines <= LINE_COVERAGE)
    for n, most in COVERAGE.items():
        kept &= shares[n] <= most
    out |= {"kept": kept, "line_coverage": lines} | {f"coverage_{n}": v for n, v in shares.items()}
    return out


def measure(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Repetition figures and verdict of every row; ``keys`` are carried along.

    A null text counts as empty, and an empty text fails for its few words.  Rows
    that occur twice are judged twice.  Each text is judged alone, so there is no
    shuffle; long texts are worked on one at a time, whole.
    """
    ship(docs.sparkSession)
    plain, carried = picked(docs, keys, text)
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                out = _measured(part.column(text))
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in keys] + [pa.array(out[n], {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[kind])
                                                      for n, kind in (c.split() for c in SCHEMA.split(", "))], [*keys, *names])

    return plain.mapInArrow(run, carried + SCHEMA)
