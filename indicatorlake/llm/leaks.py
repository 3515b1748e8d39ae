"""Benchmark decontamination: exact pieces by pigeonhole, verified with Myers' bit-parallel distance."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from indicatorlake.session import written

from .common import chunks, ship, spans_hash, windows, words_of

#: Word edits allowed, in percent of an item's words.
EDIT_PERCENT = 20
#: Items of fewer words are not searched.  Up to four words an item has no edits to spend, so only its exact words count.
LEAST_WORDS = 1
#: Bytes of items that one scan of the documents carries; more items take more scans.
BLOCK_BYTES = 16 << 20

#: Words are runs of ASCII letters, digits and all non-ASCII characters.
SEPARATORS = np.array([not (chr(b).isalnum() or b > 127) for b in range(256)])


def folded(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(texts, "").cast(pa.string()))


def myers(pattern: list[int], text: list[int], most: int) -> tuple[int, int]:
    """The smallest edit distance of the pattern to any part of the text, at most ``most`` (else -1), and where that part ends.

    One machine word, here an integer of any length, holds a column of the distance
    table as vertical steps up and down; each word of the text takes a fixed number
    of operations.
    """
    size = len(pattern)
    places: dict[int, int] = defaultdict(int)
    for k, word in enumerate(pattern):
        places[word] |= 1 << k
    every, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score = every, 0, size
    best, end = most + 1, -1
    for at, word in enumerate(text):
        same = places.get(word, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        right = down | (~(diagonal | up) & every)
        left = diagonal & up
        score += bool(right & top) - bool(left & top)
        right, left = right << 1 & every, left << 1 & every
        up = left | (~(diagonal | right) & every)
        down = diagonal & right
        if score < best:
            best, end = score, at + 1
    return (best, end) if best <= most else (-1, -1)


class Items:
    """Word sequences of test items, each once whatever ids it has, and the table of their pieces."""

    def __init__(self, items: list[tuple[object, str]], percent: int, least: int):
        words = words_of(folded(pa.array([t for _, t in items], pa.string())), SEPARATORS)
        hashes = words.hashes().view(np.int64)
        self.words: list[list[int]] = []
        self.budget: list[int] = []
        self.ids: list[list[object]] = []
        known: dict[bytes, int] = {}
        pieces: dict[int, dict[int, set[tuple[int, int]]]] = defaultdict(lambda: defaultdict(set))
        for k, (item, _) in enumerate(items):
            own = hashes[words.bounds[k] : words.bounds[k + 1]]
            if len(own) < max(1, least):
                continue
            number = known.setdefault(own.tobytes(), len(self.words))
            if number < len(self.words):
                if item not in self.ids[number]:
                    self.ids[number].append(item)
                continue
            self.words.append(own.tolist())
            self.ids.append([item])
            budget = len(own) * percent // 100
            self.budget.append(budget)
            cuts = np.linspace(0, len(own), budget + 2).astype(int)
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                key = int(spans_hash(own.view(np.uint64), np.array([low]), np.array([high]))[0])
                pieces[high - low][key].add((number, low))
        self.pieces = {n: {k: sorted(v) for k, v in table.items()} for n, table in pieces.items()}
        self.keys = {n: np.sort(np.array(list(table), np.uint64)) for n, table in self.pieces.items()}
        self.sieve = {n: np.bincount((keys >> np.uint64(48)).astype(np.int64), minlength=1 << 16) > 0 for n, keys in self.keys.items()}

    def hits(self, hashes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(word position, item, offset of the piece in it) wherever a piece stands."""
        for n, keys in self.keys.items():
            grams = windows(hashes, n)
            at = np.flatnonzero(self.sieve[n][(grams >> np.uint64(48)).astype(np.int64)])
            found = grams[at]
            place = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
            on = keys[place] == found
            for position, key in zip(at[on].tolist(), found[on].tolist()):
                for item, offset in self.pieces[n][key]:
                    yield position, item, offset


def _leaks(items: Items, texts: pa.Array) -> list[list[tuple[object, int, int]]]:
    """For every text the items it holds: (id, distance, last word + 1), of each id the nearest."""
    words = words_of(folded(texts), SEPARATORS)
    hashes = words.hashes()
    near: dict[tuple[int, int], set[int]] = defaultdict(set)
    hits = list(items.hits(hashes))
    rows = np.searchsorted(words.bounds, np.array([h[0] for h in hits], np.int64), "right") - 1
    for (position, item, offset), row in zip(hits, rows.tolist()):
        near[row, item].add(position - offset)
    out: list[dict[object, tuple[int, int]]] = [{} for _ in range(len(texts))]
    for (row, item), starts in near.items():
        low, high = int(words.bounds[row]), int(words.bounds[row + 1])
        size, budget = len(items.words[item]), items.budget[item]
        best = (budget + 1, -1)
        stretch: list[int] = []
        for start in [*sorted(starts), None]:
            if stretch and (start is None or start - stretch[-1] > size):
                begin, stop = max(low, stretch[0] - budget), min(high, stretch[-1] + size + budget)
                distance, end = myers(items.words[item], hashes[begin:stop].view(np.int64).tolist(), budget)
                if distance >= 0:
                    best = min(best, (distance, begin + end - low))
                stretch = []
            if start is not None:
                stretch.append(start)
        if best[1] >= 0:
            for own in items.ids[item]:
                out[row][own] = min(best, out[row].get(own, best))
    return [[(own, *found) for own, found in held.items()] for held in out]


_built: dict[str, object] = {}


def _items(shared: Broadcast, percent: int, least: int) -> Items:
    """The items of a block, built once in a Python worker."""
    if shared.value is not _built.get("of"):
        _built.update({"of": shared.value, "items": Items(shared.value, percent, least)})
    return _built["items"]


def _dealt(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> tuple[DataFrame, int]:
    """The items with the number of their block, dealt by hash, and how many blocks keep each to about the given bytes."""
    items = benchmark.select(benchmark[item_id].alias("item"), benchmark[text].alias("text")).where("text IS NOT NULL").distinct()
    items = written(items, "items")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    count = 1 + 2 * int(size) // block_bytes
    return items.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(count))), count


def _nearest(found: Column) -> Column:
    """Of every id the nearest entry, by id, an item without an id first."""
    by_id = F.array_sort(F.transform(found, lambda x: F.struct(x["item"].isNotNull().alias("named"), x["item"].alias("item"), x["distance"].alias("distance"), x["end"].alias("end"))))
    return F.transform(by_id, lambda x: F.struct(x["item"].alias("item"), x["distance"].alias("distance"), x["end"].alias("end")))


def find_leaks(docs: DataFrame, benchmark: DataFrame, keys: list[str], text: str = "text", item_id: str = "item_id", item_text: str = "text",
               percent: int = EDIT_PERCENT, least: int = LEAST_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The keys of every row and ``leaks``: an array of (item, distance, end), by item.

    A text holds an item if some part of it is within ``percent`` of the item's
    words in word edits, case and punctuation aside.  One of budget + 1 pieces must
    then stand there unchanged; its hits are verified by edit distance.  ``end``
    counts the words up to the end of the best part.  A null or empty text holds
    nothing.  Every text of an id is searched, and the nearest is told; an item without
    an id is told with a null one; an item of few words has no edits to spend; only
    items without a word are not searched.  Ids keep their type.  Items travel in
    blocks of a bounded size, each with a scan of the rows, which are never shuffled;
    an empty benchmark gives empty arrays.
    """
    ship(docs.sparkSession)
    held = {c: f"own_{k}" for k, c in enumerate(docs.columns)}
    kind = benchmark.schema[item_id].dataType
    shape = f"array<struct<item:{kind.simpleString()},distance:int,end:int>>"
    arrow = pa.list_(pa.struct([("item", to_arrow_type(kind)), ("distance", pa.int32()), ("end", pa.int32())]))
    context = docs.sparkSession.sparkContext

    def scan(rows: DataFrame, out: list[str], name: str, block: list[tuple[int, str]]) -> DataFrame:
        shared = context.broadcast(block)  # at most block_bytes or so
        body = held[text]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = _items(shared, percent, least)
            for batch in batches:
                for part in chunks(batch, body):
                    found = _leaks(items, part.column(body))
                    rows = [[{"item": i, "distance": d, "end": e} for i, d, e in f] for f in found]
                    yield part.select(out).append_column(name, pa.array(rows, arrow))

        schema = {f.name: f.dataType.simpleString() for f in rows.schema}
        return rows.mapInArrow(run, "".join(f"{c} {schema[c]}, " for c in out) + f"{name} {shape}")

    rows = docs.select(*[docs[c].alias(held[c]) for c in dict.fromkeys([*keys, text])])
    items, count = _dealt(benchmark, item_id, item_text, block_bytes)
    names = [f"leaks_{k}" for k in range(count)]
    for k, name in enumerate(names):
        block = [tuple(r) for r in items.where(F.col("block") == k).select("item", "text").collect()]  # one block at a time
        rows = scan(rows, rows.columns if k + 1 < count else [*(held[c] for c in keys), *names[:k]], name, block)
    found = reduce(F.concat, [F.col(name) for name in names])
    return rows.select(*[F.col(held[c]).alias(c) for c in keys], _nearest(found).alias("leaks"))
