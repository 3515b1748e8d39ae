"""Substring dedup: passages that occur elsewhere, found with suffix automata over shards of reference text."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatorlake.session import written

from .common import chunks, mixed, ship, spans_hash, windows, words_of

WINDOW = 35
#: Words of the anchors that route windows to shards.
ANCHOR = 16
#: Contexts a shard holds on average.
SHARD_CONTEXTS = 2000
#: The windows of an anchor with more different contexts than this are counted by content.
CROWDED = 512


class SuffixAutomaton:
    """All substrings of weighted sequences, with how often each occurs."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def _state(self, next_: dict[int, int], link: int, length: int) -> int:
        self.next.append(next_)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.link) - 1

    def _split(self, p: int, symbol: int, q: int) -> int:
        """The part of state q as long as p and one symbol, as a state of its own."""
        clone = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, symbol: int) -> int:
        known = self.next[last].get(symbol)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, symbol, known)
        made = self._state({}, 0, self.length[last] + 1)
        p = last
        while p >= 0 and symbol not in self.next[p]:
            self.next[p][symbol] = made
            p = self.link[p]
        if p >= 0:
            q = self.next[p][symbol]
            self.link[made] = q if self.length[q] == self.length[p] + 1 else self._split(p, symbol, q)
        return made

    def add(self, sequence: list[int], weight: int) -> None:
        state = 0
        for symbol in sequence:
            state = self._extend(state, symbol)
            self.count[state] += weight

    def finish(self) -> None:
        """Hand the counts of longer substrings down to their suffixes."""
        for state in np.argsort(np.array(self.length), kind="stable")[:0:-1].tolist():
            self.count[self.link[state]] += self.count[state]

    def statistics(self, sequence: list[int], times: int) -> list[int]:
        """At every position the length of the longest substring ending there that occurs ``times`` or more."""
        out, state, length = [], 0, 0
        next_, link, longest, count = self.next, self.link, self.length, self.count
        for symbol in sequence:
            while state and symbol not in next_[state]:
                state = link[state]
                length = longest[state]
            if symbol in next_[state]:
                state = next_[state][symbol]
                length += 1
            while state and count[state] < times:
                state = link[state]
                length = longest[state]
            out.append(length)
        return out


def _runs(hashes: np.ndarray, whole: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows that share their anchor: (first window, windows, anchor hash, hash of all words).

    A window's anchor is the leftmost of its smallest hashes of ``anchor`` words, so
    equal windows have equal anchors, wherever they stand, and their runs meet under
    one key.
    """
    grams = windows(hashes, anchor)
    reach = window - anchor + 1
    if len(grams) < reach or not whole.any():
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    place = np.lib.stride_tricks.sliding_window_view(grams, reach).argmin(axis=1) + np.arange(len(grams) - reach + 1)
    starts = np.flatnonzero(whole)
    place = place[starts]
    fresh = np.r_[True, (place[1:] != place[:-1]) | (np.diff(starts) != 1)]
    first = starts[fresh]
    size = np.diff(np.append(np.flatnonzero(fresh), len(starts)))
    return first, size, grams[place[fresh]], spans_hash(hashes, first, first + size + window - 1)


def _keyed(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(id, key, mark, text): key and mark are never null and name a row's id and text."""
    return docs.select(docs[id_column].alias("id"), docs[text].alias("text")).select(
        "id", F.coalesce(F.col("id").cast("long"), F.lit(0)).alias("key"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"), "text")


def _contexts(rows: DataFrame, window: int, anchor: int) -> DataFrame:
    """A row for every run of windows: where it starts, how many windows, its anchor and its content's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                words = words_of(part.column("text"))
                first, size, anchors, content = _runs(words.hashes(), words.same_text(window), window, anchor)
                row = words.rows[first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors.view(np.int64)), pa.array(content.view(np.int64)),
                     part.column("key").take(pa.array(row)), part.column("mark").take(pa.array(row)),
                     pa.array((first - words.bounds[row]).astype(np.int32)), pa.array(size.astype(np.int32))],
                    ["anchor", "content", "key", "mark", "start", "size"])

    return rows.select("key", "mark", "text").mapInArrow(run, "anchor long, content long, key long, mark long, start int, size int")


def _cut_out(texts: DataFrame, window: int) -> DataFrame:
    """The words (hashes) of the asked contexts of every text; ``asked`` is an array of (start, size, ...).

    A row that occurs twice is cut out twice; its contexts already count as repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                words = words_of(part.column("text"))
                hashes = words.hashes().view(np.int64)
                asked = part.column("asked")
                owner = np.repeat(np.arange(part.num_rows), pc.list_value_length(asked).to_numpy(zero_copy_only=False))
                flat = asked.flatten()
                start = flat.field("start").to_numpy() + words.bounds[owner]
                size = flat.field("size").to_numpy() + window - 1
                ends = np.cumsum(size)
                index = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size) + np.repeat(start, size)
                rows = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(rows), part.column("mark").take(rows), *(flat.field(n) for n in ("start", "anchor", "times")),
                     pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(hashes[index]))],
                    ["key", "mark", "start", "anchor", "times", "words"])

    return texts.mapInArrow(run, "key long, mark long, start int, anchor long, times long, words array<long>")


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """The hash of every window of the asked contexts of every text, with its place and how often its context occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                words = words_of(part.column("text"))
                hashes = windows(words.hashes(), window).view(np.int64)
                asked = part.column("asked")
                owner = np.repeat(np.arange(part.num_rows), pc.list_value_length(asked).to_numpy(zero_copy_only=False))
                flat = asked.flatten()
                size = flat.field("size").to_numpy()
                context = np.repeat(np.arange(len(size)), size)
                start = flat.field("start").to_numpy()[context] + np.arange(len(context)) - np.repeat(np.cumsum(size) - size, size)
                rows = owner[context]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[start + words.bounds[rows]]), part.column("key").take(pa.array(rows)), part.column("mark").take(pa.array(rows)),
                     pa.array(start.astype(np.int32)), *(flat.field(n).take(pa.array(context)) for n in ("times", "anchor"))],
                    ["window", "key", "mark", "start", "times", "anchor"])

    return texts.mapInArrow(run, "window long, key long, mark long, start int, times long, anchor long")


def _routed(contexts: DataFrame, shards: int) -> DataFrame:
    """Contexts with the shard of their anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchors = batch.column("anchor").to_numpy().view(np.uint64)
            yield batch.select(["key", "mark", "start", "times", "words"]).append_column(
                "shard", pa.array((mixed(anchors) % np.uint64(shards)).astype(np.int64)))

    return contexts.mapInArrow(run, "key long, mark long, start int, times long, words array<long>, shard long")


def _matched(window: int):
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        """Build the shard's automaton, stream its contexts through, and keep the windows found twice."""
        automaton = SuffixAutomaton()
        sequences = [w.tolist() for w in shard["words"]]
        times = shard["times"].tolist()
        for sequence, n in zip(sequences, times):
            automaton.add(sequence, n)
        automaton.finish()
        key, mark, start, size = array("q"), array("q"), array("q"), array("q")
        for sequence, n, k, m, at in zip(sequences, times, shard["key"].tolist(), shard["mark"].tolist(), shard["start"].tolist()):
            if n > 1:
                continue  # all its windows are known to repeat
            since = None
            for end, length in enumerate([*automaton.statistics(sequence, 2), 0]):
                if length >= window:
                    since = end - window + 1 if since is None else since
                elif since is not None:
                    key.append(k)
                    mark.append(m)
                    start.append(at + since)
                    size.append(end - window + 1 - since)
                    since = None
        return pd.DataFrame({"key": np.array(key, np.int64), "mark": np.array(mark, np.int64),
                             "start": np.array(start, np.int32), "size": np.array(size, np.int32)})

    return run


def repeated_windows(rows: DataFrame, texts: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Runs of windows whose words also start elsewhere: (key, mark, start, size), start counted in words of the text.

    1. Every text gives its contexts, runs of windows under one anchor; anchors
       that occur once cannot hold a repeated window and leave.
    2. Contexts that occur twice as a whole repeat in all their windows.
    3. Of the others, those that share an anchor with another context are cut out of
       their texts as reference, with the number of times each occurs, and dealt to
       shards by anchor; a suffix automaton of each shard gives the matching
       statistics of its contexts.
    4. Anchors of very many contexts have no shard: their windows are counted by
       content, and those found twice are joined back to their places, so that a
       window common to many texts is no group of rows in one task.
    """
    seen = _contexts(rows, window, anchor)
    # stored, so that the join below is one of plain shuffles and a hot anchor can be split
    twice = written(_contexts(rows, window, anchor).groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
    met = written(seen.join(twice, "anchor"), "contexts")
    contents = written(met.groupBy("anchor", "content").agg(
        F.count("*").alias("times"), F.min(F.struct("key", "mark", "start", "size")).alias("place")), "contents")
    anchors = written(contents.groupBy("anchor").agg(
        F.count("*").alias("kinds"), F.min("times").alias("fewest")).where("kinds > 1 and fewest = 1"), "mixed")
    reference = written(contents.join(anchors, "anchor").select(
        "place.*", "anchor", "times", (F.col("kinds") > CROWDED).alias("crowded")), "reference")
    asked = {crowded: texts.join(
        reference.where(F.col("crowded") == crowded).groupBy("key", "mark").agg(F.collect_list(F.struct("start", "size", "anchor", "times")).alias("asked")),
        ["key", "mark"]).select("id", "key", "mark", "text", "asked") for crowded in (False, True)}
    shards = 1 + reference.where("not crowded").count() // SHARD_CONTEXTS
    routed = _routed(_cut_out(asked[False], window), shards)
    partial = routed.groupBy("shard").applyInPandas(_matched(window), "key long, mark long, start int, size int")
    # stored, so that the rows of a window that many texts share can be split over tasks
    places = written(_windows(asked[True], window), "windows")
    # equal windows have equal anchors, so both hashes together name a window, by 128 bits
    again = written(places.groupBy("anchor", "window").agg(F.sum("times").alias("n")).where("n > 1").select("anchor", "window"), "again")
    single = places.where("times = 1").join(again, ["anchor", "window"]).select("key", "mark", "start", F.lit(1).alias("size"))
    wholly = met.join(contents.where("times > 1").select("anchor", "content"), ["anchor", "content"]).select("key", "mark", "start", "size")
    return wholly.unionAll(partial).unionAll(single)


def _kept_words(text: str, spans: list[dict] | None, window: int) -> tuple[int, int, str]:
    words = text.encode("utf-8", "surrogatepass").split()
    if not spans:
        return len(words), 0, b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int32)
    for span in spans:
        steps[span["start"]] += 1
        steps[span["start"] + span["size"] + window - 1] -= 1
    kept = np.cumsum(steps[:-1]) == 0
    return len(words), len(words) - int(kept.sum()), b" ".join([w for w, k in zip(words, kept.tolist()) if k])


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Per row: id, n_words, n_removed and ``kept``, the words left, joined by one space.

    Words covered by a window that occurs again, in another row or the same one, go,
    at all places; what remains is not judged again.  Equal rows repeat each other,
    whatever their ids.  A null text has no words; texts shorter than a window stay.
    Texts of any length are worked on whole; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    rows = _keyed(docs, id_column, text)
    texts = rows.repartition("key", "mark")
    found = repeated_windows(rows, texts, window, anchor)
    # a set, so that equal rows do not repeat their spans; it holds as many as the text has contexts
    spans = found.groupBy("key", "mark").agg(F.collect_set(F.struct("start", "size")).alias("spans"))
    joined = texts.join(spans, ["key", "mark"], "left").select("id", "text", "spans")
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                out = [_kept_words(t or "", s, window) for t, s in zip(part.column("text").to_pylist(), part.column("spans").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *(pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)),
                     pa.array([o[2] for o in out], pa.binary()).cast(pa.string())], [id_column, "n_words", "n_removed", "kept"])

    return joined.mapInArrow(run, f"`{id_column}` {kind}, n_words long, n_removed long, kept string")
